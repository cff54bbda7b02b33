"""Inputs that were once read wrongly or accepted in silence."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortweave.functions.dates import whole_years
from cohortweave.functions.values import as_date, unreadable_dates
from cohortweave.operators.categorical import CategoricalSpec, categorical
from cohortweave.operators.coded import CodedDefinition, CodeSource, advanced_coded_batch
from cohortweave.operators.quantiles import exact_quantiles
from cohortweave.operators.risk import RiskRule
from cohortweave.plans.cohort import complete_spec
from cohortweave.sources.delimited import scan_delimited


def test_date_layouts(spark):
    texts = ["2022-01-05", "05-JAN-2022", "2022/01/05", "01/05/2022 10:30", "Jan 5, 2022", "01-05-2022", "1/5/22", "1/5/2022", "20220105",
             "5 Jan 2022", "January 5, 2022", "Jan 5 2022", "2022/01/05 10:30", "05-Jan-22", "01/05/2022 10:30 PM"]
    df = spark.createDataFrame([(t,) for t in [*texts, "soon", "13/45/2022"]], "d string")
    got = [r[0] for r in df.select(as_date(df, "d")).collect()]
    assert got == [datetime.date(2022, 1, 5)] * len(texts) + [None, None]
    assert unreadable_dates(df, ["d"]).first()["d"] == 2
    day_first = df.select(as_date(df.where("d = '01-05-2022'"), "d", ["d-M-yyyy"]).alias("x")).where("x IS NOT NULL").collect()
    assert datetime.date(2022, 5, 1) in {r[0] for r in day_first}


def test_whole_years(spark):
    cases = [("2000-02-29", "2023-02-28", 22), ("2000-02-29", "2023-03-01", 23), ("2000-05-10", "2020-05-10", 20), ("2000-05-10", "2020-05-09", 19), (None, "2020-01-01", None)]
    df = spark.createDataFrame(cases, "b string, o string, y int")
    got = df.select(whole_years(F.to_date("b"), F.to_date("o")).alias("a"), "y").collect()
    assert [r["a"] for r in got] == [r["y"] for r in got]


def test_quantiles_equal_linear_interpolation(spark):
    df = spark.range(20_000).select((F.col("id") % 40).alias("g"), F.round(F.rand(7), 3).alias("v"))
    probabilities = [0.0, 0.1, 0.25, 1 / 3, 0.9, 1.0]
    got = {r["g"]: (r["n"], r["quantiles"]) for r in exact_quantiles(df, ["g"], F.col("v"), probabilities).collect()}
    values = {}
    for g, v in df.collect():
        values.setdefault(g, []).append(v)
    for g, vs in values.items():
        assert got[g][0] == len(vs)
        assert got[g][1] == pytest.approx(np.quantile(vs, probabilities).tolist(), abs=1e-12)


def test_whitespace_table_keeps_control_characters_and_refuses_surplus(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x y\n1 2\x013\n\n4 5\n")
    assert [tuple(r) for r in scan_delimited(spark, str(tmp_path / "a.txt"), r"\s+").collect()] == [("1", "2\x013"), ("4", "5")]
    (tmp_path / "b.txt").write_text("x y\n1 2 3\n")
    with pytest.raises(Exception, match="more than 2 fields"):
        scan_delimited(spark, str(tmp_path / "b.txt"), r"\s+").collect()


@pytest.mark.parametrize("sep, header, other, line", [(None, "a,b", "b,a", "3,4"), (r"\s+", "a b", "b a", "3 4"), ("::", "a::b", "b::a", "3::4")])
def test_other_header_order_is_refused(spark, tmp_path, sep, header, other, line):
    (tmp_path / "1.csv").write_text(f"{header}\n{line}\n")
    (tmp_path / "2.csv").write_text(f"{header}\n{line}\n")
    assert scan_delimited(spark, str(tmp_path), sep).count() == 2
    (tmp_path / "2.csv").write_text(f"{other}\n{line}\n")
    with pytest.raises(Exception):
        scan_delimited(spark, str(tmp_path), sep).collect()


def test_surplus_fields_are_refused_and_missing_ones_null(spark, tmp_path):
    (tmp_path / "1.csv").write_text('a,b,c\n1,2,3\n4\n5,"x,y",NA\n"say ""hi""",,\n')
    assert [tuple(r) for r in scan_delimited(spark, str(tmp_path / "1.csv")).collect()] == [("1", "2", "3"), ("4", None, None), ("5", "x,y", None), ('say "hi"', None, None)]
    assert [r[0] for r in scan_delimited(spark, str(tmp_path / "1.csv")).select("b").collect()] == ["2", None, "x,y", None]
    (tmp_path / "2.csv").write_text('a,b\n1,2\n1,"2,3",4\n')
    for columns in (["a", "b"], ["a"]):
        with pytest.raises(Exception, match="more than 2 fields after '1'"):
            scan_delimited(spark, str(tmp_path / "2.csv")).select(*columns).collect()
    with pytest.raises(Exception, match="more than 2 fields"):
        scan_delimited(spark, str(tmp_path / "2.csv")).count()


def test_one_hot_spec_serves_two_tables(long_of):
    spec = CategoricalSpec("C", one_hot=True)
    first = categorical(long_of([("s", "categorical", "C", v, None) for v in "xy"]), spec)
    second = categorical(long_of([("s", "categorical", "C", v, None) for v in "zw"]), spec)
    assert first.columns != second.columns and spec.categories is None
    assert {c: second.first()[c] for c in second.columns if c != "sample_ID"} == {"C_w": 1, "C_z": 1}


def test_mixed_codes_are_ordered_as_text():
    assert list(CategoricalSpec("C", dictionary={"a": 2, "b": "x", "c": 10}).codes()) == [10, 2, "x"]


def test_rules_are_checked(long_of):
    with pytest.raises(ValueError, match="labels"):
        RiskRule("threshold", "a", "b", cutoffs=(1.0, 2.0), labels=("low", "high"))
    with pytest.raises(ValueError, match="rise"):
        RiskRule("threshold", "a", "b", cutoffs=(2.0, 1.0))
    with pytest.raises(ValueError, match="statz"):
        complete_spec({"phenotype_name": "P", "data_type": "quantitative", "table": "t", "value_col": "v", "statz": ["mean"]})
    same = CodedDefinition("D", (CodeSource("S", ("A",)),))
    with pytest.raises(ValueError, match="more than one definition of D"):
        advanced_coded_batch(long_of([("s", "coded", "S", "A", None, "S")]), [same, same])
