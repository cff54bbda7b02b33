import pytest
from conftest import by_sample
from pyspark.sql import functions as F

from cohortweave.functions.vocabulary import (
    detect_column_type, detect_value_type, normalize_data_type, profile_table, route_by_data_type)
from cohortweave.operators import coded as E
from cohortweave.operators.codes import code_pattern_match, dotted_children, match_codes, normalize_patterns, pattern_keys, sample_has_any_code
from workload.registry import QUERIES


@pytest.mark.parametrize("raw, expected", [
    ("ICD09", "ICD9"), ("ICD-9-CM", "ICD9"), ("icd10", "ICD10"), ("ICD10CM", "ICD10"), ("ICD10", "ICD10"),
    ("QUANT", "quantitative"), ("LAB", "measurements"), ("MEDICATION", "drugs"), ("SNOMED_CT", "SNOMED"),
    ("DEMO", "demographic"), ("  ICD09 \t", "ICD9"), ("CUSTOM", "CUSTOM"), ("", ""), (" mine ", "mine"), (None, None)])
def test_normalize_data_type(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(normalize_data_type(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize("code, pattern, expected", [
    ("N80.0", "N80.0", True), ("N80.1", "N80.0", False), ("N80.0", "N80", False), ("617", "617", True),
    ("N80.11", "N80.*", True), ("N80X0", "N80.*", False), ("N81.0", "N80.*", False), ("I70.09", "I70.0**", True),
    ("I70.10", "I70.0**", False), ("I83.0", "I83.", True), ("I830", "I83.", False), ("I83", "I83.", False),
    ("N80.0", "", False), ("", "N80.*", False), ("  N80.0  ", "  N80.0  ", True), ("I251", "I25*", True),
    ("I251", "I26*", False), ("N80.0", "*", True), ("n80.0", "N80.*", False), ("N80.0", "*80.0", False), (None, "N*", False)])
def test_code_pattern(spark, code, pattern, expected):
    df = spark.createDataFrame([(code,)], "c string")
    assert df.select(code_pattern_match(F.col("c"), [pattern])).first()[0] is expected


def test_normalize_patterns():
    assert normalize_patterns(["E11", "E10.5", "E12.*", "I83.", "", " ", " 250 "]) == [
        "E11.*", "E10.5", "E12.*", "I83.", "250.*"]
    assert normalize_patterns(["E11", "E11.*"], prefix_matching=False) == ["E11", "E11.*"]
    assert normalize_patterns(None) == []


@pytest.mark.parametrize("pattern, expected", [
    ("E*", ("E*", True)), ("*", ("*", False)), ("E11.*", ("E11.", True)), ("E11", ("E11", False)), ("I83.", ("I83.", True)), (".", (".", False)),
    ("N.", ("N.", True)), ("*80.0", ("*80.0", True)), ("I70.0**", ("I70.0", True))])
def test_pattern_keys(spark, pattern, expected):
    df = spark.createDataFrame([(pattern,)], "p string")
    assert tuple(df.select(F.inline(F.array(pattern_keys(F.col("p"))))).first()) == expected


def test_dotted_children_follow_the_list_form(spark):
    listed = ["E11", "E10.5", "E12.*", "I83.", "250", "*"]
    df = spark.createDataFrame([(p,) for p in listed], "p string")
    assert [r[0] for r in df.select(dotted_children(F.col("p"))).collect()] == normalize_patterns(listed)


def test_a_million_patterns(spark):
    """Codes meet their patterns by equality of prefixes: no join but on (source, key, kind), each match once."""
    codes = spark.range(3000).select(F.lit("S").alias("source"), F.format_string("K%05d.%d", F.col("id") % 1000, F.col("id") % 7).alias("code")).distinct()
    ids = spark.range(1_000_000)
    patterns = ids.select(F.col("id").alias("label"), F.lit("S").alias("pattern_source"), F.concat(F.lit("K"), F.lpad((F.col("id") % 100_000).cast("string"), 5, "0"),
        F.when(F.col("id") < 500_000, ".").otherwise(F.concat(F.lit("."), (F.col("id") % 10).cast("string")))).alias("key"), (F.col("id") < 500_000).alias("is_prefix"))
    met = match_codes(codes, patterns)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    expected = 0
    exact = {f"K{i % 1000:05d}.{i % 7}" for i in range(3000)}
    for code in exact:
        expected += 5 + (5 if int(code[5]) == int(code[7]) else 0)  # five prefixes hold it, five exact ones when its digits fit
    assert met.count() == expected


def test_two_character_rule(spark, long_of):
    long = long_of([("P1", "coded", "N80.0", "N80.0", None), ("P2", "coded", "N", "N", None)])
    assert by_sample(sample_has_any_code(long, ["N*", "*"])) == {"P1": False, "P2": False}
    assert by_sample(sample_has_any_code(long, ["N8*"])) == {"P1": True, "P2": False}
    assert by_sample(sample_has_any_code(long, ["N"])) == {"P1": False, "P2": True}
    assert by_sample(sample_has_any_code(long, ["", None, " "])) == {"P1": False, "P2": False}


@pytest.mark.parametrize("values, expected", [
    (["N80.0", "N80.1", "I10", "Z34.10"], "ICD10"), (["617", "617.1", "250.00", "714.0"], "ICD9"),
    (["27.8", "28.4", "1"], "quantitative"), (["1", "0"], "quantitative"), ([], "unknown"), ([None, None], "unknown"),
    (["male", "female"], "categorical"), (["N80.0"] * 8 + ["UNKNOWN"], "ICD10"), (["N80.0"] * 7 + ["x"] * 3, "categorical")])
def test_detect_value_type(spark, values, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    found = [(r.column, r.n_values, r.value_type) for r in detect_value_type(df, ["v"]).collect()]
    assert found == [("v", sum(v is not None for v in values), expected)]


def test_detection_takes_all_values(spark):
    df = spark.range(200).selectExpr("id", "CASE WHEN id < 60 THEN 'E11.9' ELSE 'x' END AS v")
    assert detect_value_type(df, ["v"]).first().value_type == "categorical"


@pytest.mark.parametrize("name, expected", [
    ("N80.0", "ICD10"), ("617", "ICD9"), ("250.00", "ICD9"), ("bmi", "quantitative"), ("WEIGHT_KG", "quantitative"),
    ("sex", "demographic"), ("RACE", "demographic"), ("ICD10_col", "ICD10"), ("icd09_x", "ICD9"), ("SOME_COL", None), ("", None)])
def test_detect_column_type(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(detect_column_type(F.col("n"))).first()[0] == expected


def test_profile(spark):
    df = spark.createDataFrame([("E11.9", "21.5", "f")], "code string, BMI string, SEX string")
    profile = {r.column: (r.value_type, r.name_type) for r in profile_table(df).collect()}
    assert profile == {"code": ("ICD10", None), "BMI": ("quantitative", "quantitative"), "SEX": ("categorical", "demographic")}


def test_routing(long_of):
    rows = [("P", t, "x", "1", None) for t in ("Quantitative", "vitals", "MEASUREMENTS", "survey", "Demographics", "coded", None)]
    assert route_by_data_type(long_of(rows), "quantitative").count() == 3
    assert route_by_data_type(long_of(rows), "categorical").count() == 2
    assert route_by_data_type(long_of(rows).drop("data_type"), "categorical").count() == 7


def coded(long_of, rows):
    return long_of([(s, "coded", c, c, "2020-01-01", src) for s, c, src in rows])


def people(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "sample_ID string")


def test_basic_coded(spark, long_of):
    long = coded(long_of, [("P1", "N80.0", "D"), ("P1", "N80.0", "D"), ("P2", "N80.0", "D"), (None, "N80.0", "D"), ("P4", "E11", "D")])
    everyone = people(spark, "P1", "P2", "P3")
    assert by_sample(E.basic_coded(long, "N80.0")) == {"P1": 1, "P2": 1}
    assert by_sample(E.basic_coded(long, "N80.0", everyone, 2)) == {"P1": 1, "P2": None, "P3": None}
    assert by_sample(E.basic_coded(long, "N80.0", everyone, 2, True)) == {"P1": 1, "P2": None, "P3": 0}
    assert by_sample(E.basic_coded(long, "Z99", everyone, 1, True)) == {"P1": 0, "P2": 0, "P3": 0}


def test_basic_coded_matrix(spark, long_of):
    long = coded(long_of, [("P1", "N80.0", "D"), ("P1", "N80.0", "D"), ("P2", "N80.0", "D"), ("P2", "E11", "D")])
    matrix = {r.sample_ID: tuple(r)[1:] for r in E.basic_coded_matrix(long, None, people(spark, "P1", "P2", "P3"), 2, True).collect()}
    assert matrix == {"P1": (0, 1), "P2": (None, None), "P3": (0, 0)}
    cells = {(r.sample_ID, r.phenotype): r.value for r in E.basic_coded_long(long, 2).collect()}
    assert cells == {("P1", "N80.0"): 1, ("P2", "N80.0"): None, ("P2", "E11"): None}
    with pytest.raises(ValueError):
        E.list_codes(long, limit=1)


def verdict(spark, long_of, rows, sources, ids=("P1",), **settings):
    definition = E.CodedDefinition("T2D", tuple(sources), **settings)
    return by_sample(E.advanced_coded(coded(long_of, rows), definition, people(spark, *ids) if ids else None))


ICD = E.CodeSource("ICD10", ("E11",))


def test_case_and_absent(spark, long_of):
    rows = [("P1", "E11.9", "ICD10")]
    assert verdict(spark, long_of, rows, [ICD], ("P1", "P2")) == {"P1": 1, "P2": None}
    assert verdict(spark, long_of, rows, [ICD], ("P1", "P2"), missing_as_control=True) == {"P1": 1, "P2": 0}
    assert verdict(spark, long_of, rows + [("P3", "Z00", "ICD10"), ("P4", "Z00", "OTHER")], [ICD], None) == {"P1": 1, "P3": None}


def test_exclusions(spark, long_of):
    both = [("P1", "E11.9", "ICD10"), ("P1", "E10.9", "ICD10")]
    excluded = E.CodeSource("ICD10", ("E11",), case_exclude=("E10",))
    unknown = E.CodeSource("ICD10", ("E11",), control_exclude=("E10",))
    assert verdict(spark, long_of, both, [excluded]) == {"P1": 0}
    assert verdict(spark, long_of, both[:1], [excluded]) == {"P1": 1}
    assert verdict(spark, long_of, both[1:], [unknown], missing_as_control=True) == {"P1": None}
    assert verdict(spark, long_of, both, [unknown], missing_as_control=True) == {"P1": 1}


def test_prefix_forms(spark, long_of):
    assert verdict(spark, long_of, [("P1", "E110", "ICD10")], [ICD]) == {"P1": None}
    assert verdict(spark, long_of, [("P1", "E11", "ICD10")], [ICD]) == {"P1": None}
    assert verdict(spark, long_of, [("P1", " E11.9 ", "ICD10")], [E.CodeSource("ICD10", ("E11.**",))]) == {"P1": 1}


def test_min_occurrences_is_per_code(spark, long_of):
    two_codes = [("P1", "E11.9", "ICD10"), ("P1", "E11.65", "ICD10")]
    assert verdict(spark, long_of, two_codes, [ICD], min_occurrences=2) == {"P1": None}
    assert verdict(spark, long_of, two_codes + two_codes[:1], [ICD], min_occurrences=2) == {"P1": 1}
    # The same code in two sources is counted together.
    pooled = [E.CodeSource("A", ("E11",)), E.CodeSource("B", ("E11",))]
    assert verdict(spark, long_of, [("P1", "E11.9", "A"), ("P1", "E11.9", "B")], pooled, min_occurrences=2) == {"P1": 1}


def test_sources_are_pooled(spark, long_of):
    sources = [E.CodeSource("ICD10", ("E11",), ("E10",)), E.CodeSource("ICD9", ("250.0", "250.2"))]
    assert verdict(spark, long_of, [("P1", "E12.9", "ICD10"), ("P1", "250.0", "ICD9")], sources) == {"P1": 1}
    assert verdict(spark, long_of, [("P1", "E10.9", "ICD10"), ("P1", "250.0", "ICD9")], sources) == {"P1": 0}
    with pytest.raises(ValueError):
        E.advanced_coded(coded(long_of, [("P1", "x", "y")]).drop("source"), E.CodedDefinition("D", tuple(sources)))


@pytest.mark.parametrize("of_definition, of_source, code, expected", [
    (False, None, "99213.1", None), (False, None, "99213", 1), (True, False, "99213.1", None), (False, True, "99213.1", 1)])
def test_prefix_flag(spark, long_of, of_definition, of_source, code, expected):
    source = E.CodeSource("CPT", ("99213",), prefix_matching=of_source)
    assert verdict(spark, long_of, [("P1", code, "CPT")], [source], prefix_matching=of_definition) == {"P1": expected}


LIBRARY = [
    E.CodedDefinition("X", (E.CodeSource("A", ("E11",), ("E10.1",)), E.CodeSource("B", ("E11.9",))), min_occurrences=1),
    E.CodedDefinition("Y", (E.CodeSource("B", ("E10",)),), missing_as_control=True),
    E.CodedDefinition("Z", (E.CodeSource("A", ("Q1",), (), ("E10",)),))]
LIBRARY_ROWS = [("P1", "E11.9", "A"), ("P1", "E10.1", "A"), ("P2", "E11.9", "B"), ("P2", "E11.9", "A"), ("P3", "E10.1", "B"), ("P4", None, "A"), (None, "E11.9", "A")]


def test_batch_gives_decided_pairs_and_wanted_controls(spark, long_of):
    long = coded(long_of, LIBRARY_ROWS)
    answer = lambda df: sorted(map(tuple, df.collect()), key=str)
    decided = [("P1", "X", 0), ("P1", "Z", None), ("P2", "X", 1), ("P2", "Y", 0), ("P3", "Y", 1)]
    assert answer(E.advanced_coded_batch(long, LIBRARY)) == sorted(decided, key=str)
    others = [("P3", "X", None), ("P2", "Z", None), ("P4", "X", None), ("P4", "Z", None)]  # P1 and P4 have no row in the source of Y
    assert answer(E.advanced_coded_batch(long, LIBRARY, undecided=True)) == sorted(decided + others, key=str)
    roster = people(spark, "P1", "P9")
    assert answer(E.advanced_coded_batch(long, LIBRARY, roster)) == sorted([("P1", "X", 0), ("P1", "Z", None), ("P1", "Y", 0), ("P9", "Y", 0)], key=str)
    matrix = {r.sample_ID: (r.X, r.Y, r.Z) for r in E.advanced_coded_matrix(long, LIBRARY).collect()}
    assert matrix == {"P1": (0, None, None), "P2": (1, 0, None), "P3": (None, 1, None), "P4": (None, None, None)}
    assert E.advanced_coded_batch(long.where("false"), LIBRARY).count() == 0


def test_source_is_read_once(spark, long_of, tmp_path):
    coded(long_of, LIBRARY_ROWS).write.parquet(str(tmp_path / "codes"))
    long = spark.read.parquet(str(tmp_path / "codes"))
    for df in (E.advanced_coded_matrix(long, LIBRARY), E.advanced_coded_batch(long, LIBRARY)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert str(tmp_path) not in plan and plan.count("FileScan") == 2  # distinct codes, counts


def test_batch_joins_on_the_head(spark, long_of):
    long = coded(long_of, [("P1", "E11.9", "ICD10")])
    df = E.advanced_coded_batch(long, [E.CodedDefinition("T2D", (ICD,))])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "BroadcastHashJoin" in plan


def test_fifty_thousand_codes_in_blocks(spark, long_of, tmp_path):
    """A vocabulary that fits no table as columns is written once and read back a block at a time."""
    long = spark.range(120_000).select(
        F.format_string("P%d", F.col("id") % 7).alias("sample_ID"), F.lit("coded").alias("data_type"),
        F.format_string("K%05d", F.col("id") % 50_000).alias("phenotype"), F.lit("x").alias("value"))
    path = str(tmp_path / "blocks")
    E.write_code_blocks(long, path, block=200, min_occurrences=2)
    catalogue = spark.read.parquet(f"{path}/catalogue")
    assert catalogue.count() == 50_000 and catalogue.select("block").distinct().count() == 250
    got = E.read_code_block(spark, path, "101", people(spark, *(f"P{i}" for i in range(9))), missing_as_control=True)
    assert len(got.columns) == 201 and got.columns[1] == "K20000"
    narrow = long.where("phenotype BETWEEN 'K20000' AND 'K20199'")
    expected = E.basic_coded_matrix(narrow, None, people(spark, *(f"P{i}" for i in range(9))), 2, True)
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    assert E.read_code_block(spark, path, "101").count() == 7


def code_tables(spark, folder, items):
    """The tables that coded rows are laid out from: items of (order, flag, line number, status), order o belonging to customer 10 o."""
    spark.createDataFrame([(o, 7, flag, n, status, "1995-01-02") for o, flag, n, status in items],
                          "l_orderkey long, l_partkey long, l_returnflag string, l_linenumber int, l_linestatus string, l_shipdate string"
                          ).write.parquet(str(folder / "lineitem.parquet"))
    spark.createDataFrame([(o, 10 * o) for o in range(1, 5)], "o_orderkey long, o_custkey long").write.parquet(str(folder / "orders.parquet"))
    spark.createDataFrame([(7, 45)], "p_partkey long, p_size int").write.parquet(str(folder / "part.parquet"))
    return str(folder)


def test_registered_batch_has_every_pair(spark, tmp_path):
    """a sample with rows in a source of a definition has a row for it, undecided ones too; none for other definitions."""
    folder = code_tables(spark, tmp_path, [(1, "A", 3, "F"), (2, "N", 1, "O")])
    rows = {(r.sample_ID, r.phenotype): r.value for r in QUERIES["advanced_coded_batch"](spark, folder).collect()}
    assert {p for s, p in rows if s == "10"} == {f"D{i:02d}" for i in range(1, 41)}
    assert {p for s, p in rows if s == "20"} == {f"D{i:02d}" for i in range(1, 41, 2)}
    assert rows["10", "D03"] is None and rows["10", "D04"] == 0


def test_blocks_are_read_as_columns_without_a_wide_copy(spark, tmp_path):
    """empty cells become no rows, blocks are read side by side, and the tables are joined once."""
    df = QUERIES["basic_coded_blocks"](spark, code_tables(spark, tmp_path, [(1, "A", 3, "F"), (1, "A", 3, "O"), (2, "N", 1, "O"), (2, "A", 3, "O"), (2, "A", 3, "O")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "cells" in plan.split("ReadSchema")[1][:80]
    assert sorted(map(tuple, df.collect())) == [("10", "A45.3", 1), ("20", "A45.3", 1)]


def test_blocks_list_codes_without_a_sample(spark, long_of, tmp_path):
    path = str(tmp_path / "blocks")
    E.write_code_blocks(long_of([("P1", "coded", "A", "x", None), (None, "coded", "B", "x", None), ("P2", "coded", None, "x", None)]), path, 5)
    assert sorted(r.phenotype for r in spark.read.parquet(f"{path}/catalogue").collect()) == ["A", "B"]
    assert [tuple(r) for r in E.read_code_block(spark, path, "1").collect()] == [("P1", 1, None)]


def test_definitions_pool_without_sorting_rows(spark, long_of):
    """F8 to F10: before the verdicts of a sample are listed, no state grows with the rows; counts do not move to meet the patterns."""
    long = coded(long_of, LIBRARY_ROWS)
    plan = E.advanced_coded_matrix(long, LIBRARY)._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and plan.count("Exchange hashpartitioning") <= 1 and "BroadcastHashJoin" in plan
