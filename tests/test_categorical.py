import pytest
from conftest import by_sample

from cohortweave.operators.categorical import CategoricalSpec, categorical, categorical_matrix_multi, list_categories


@pytest.fixture
def sex(long_of):
    rows = [("P1", "female"), ("P1", "female"), ("P1", "male"), ("P2", "male"), ("P3", "unknown"), (None, "male"), ("P3", None)]
    return long_of([(s, "categorical", "SEX", v, None) for s, v in rows] + [("P9", "categorical", "OTHER", "male", None)])


@pytest.fixture
def everyone(spark):
    return spark.createDataFrame([("P1",), ("P2",), ("P3",), ("P4",)], "sample_ID string")


def test_binary(sex, everyone):
    assert by_sample(categorical(sex, CategoricalSpec("SEX"))) == {"P1": 1, "P2": 1, "P3": 1}
    assert by_sample(categorical(sex, CategoricalSpec("SEX"), everyone)) == {"P1": 1, "P2": 1, "P3": 1, "P4": None}
    spec = CategoricalSpec("SEX", "S", missing_as_control=True, min_occurrences=3)
    assert by_sample(categorical(sex, spec, everyone)) == {"P1": 1, "P2": None, "P3": None, "P4": 0}


def test_dictionary(sex, everyone):
    spec = CategoricalSpec("SEX", dictionary={"female": 1, "male": 0, "unknown": "NA"}, missing_as_control=True)
    assert by_sample(categorical(sex, spec, everyone)) == {"P1": 1, "P2": 0, "P3": None, "P4": 0}


def test_dictionary_ties_take_the_smallest(long_of):
    long = long_of([("P1", "categorical", "X", v, None) for v in ("b", "a", "c", "c2")])
    spec = CategoricalSpec("X", dictionary={"a": 7, "b": 2, "c": 5, "c2": 5, "z": 1})
    assert by_sample(categorical(long, spec)) == {"P1": 5}
    spec = CategoricalSpec("X", dictionary={"a": 7, "b": 2, "c": 5})
    assert by_sample(categorical(long, spec)) == {"P1": 2}
    assert by_sample(categorical(long, CategoricalSpec("X", dictionary={"a": 0.5}))) == {"P1": 0.5}
    assert by_sample(categorical(long, CategoricalSpec("X", dictionary={"a": "x", "q": "y"}))) == {"P1": "x"}
    assert by_sample(categorical(long, CategoricalSpec("X", dictionary={"a": None}))) == {"P1": None}


def test_one_hot(sex, everyone):
    table = categorical(sex, CategoricalSpec("SEX", one_hot=True), everyone)
    assert table.columns == ["sample_ID", "SEX_female", "SEX_male", "SEX_unknown"]
    assert sorted(map(tuple, table.collect())) == [
        ("P1", 1, 1, 0), ("P2", 0, 1, 0), ("P3", 0, 0, 1), ("P4", None, None, None)]
    named = categorical(sex, CategoricalSpec("SEX", one_hot=True, categories=["male", "x"], missing_as_control=True), everyone)
    assert sorted(map(tuple, named.collect())) == [("P1", 1, 0), ("P2", 1, 0), ("P3", 0, 0), ("P4", 0, 0)]


def test_categories_come_from_samples_with_enough_rows(sex):
    assert list_categories(sex, CategoricalSpec("SEX", min_occurrences=3)) == ["female", "male"]
    with pytest.raises(ValueError):
        list_categories(sex, CategoricalSpec("SEX"), limit=1)


def test_matrix_of_all_samples(sex):
    table = categorical_matrix_multi(sex, [
        CategoricalSpec("SEX", min_occurrences=3), CategoricalSpec("OTHER", dictionary={"male": 4}, min_occurrences=3)])
    assert sorted(map(tuple, table.collect())) == [("P1", 1, None), ("P2", 0, None), ("P3", 0, None), ("P9", None, 4)]


def test_a_text_under_one_code_twice_counts_once(sex, everyone):
    spec = CategoricalSpec("SEX", "S", dictionary={"male": 1, "female": 2, 7: 2, "7": 2})
    assert by_sample(categorical(sex, spec, everyone)) == {"P1": 2, "P2": 1, "P3": None, "P4": None}
    more = sex.union(sex.where("sample_ID = 'P3'").selectExpr("'P4'", "data_type", "phenotype", "'7'", "occurrence_date").limit(1))
    assert by_sample(categorical(more, spec, everyone))["P4"] == 2


def test_a_thousand_one_hot_columns(sex, everyone):
    names = [f"c{i}" for i in range(999)] + ["male"]
    row = categorical(sex, CategoricalSpec("SEX", "S", one_hot=True, categories=names), everyone).where("sample_ID = 'P1'").first()
    assert len(row) == 1001 and row["S_male"] == 1 and sum(row[1:]) == 1
