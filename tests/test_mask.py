import datetime
import random

import pytest
from pyspark.sql import functions as F

from cohortweave.operators import mask as M

DAY = datetime.date.fromisoformat


def marks(long_of, rows):
    return long_of([(s, "coded", c, c, d, src) for s, c, d, src in rows])


def windows_of(df):
    return sorted((r.sample_ID, r.event_type, str(r.window_start), str(r.window_end)) for r in df.collect())


def test_window_dates(long_of):
    long = marks(long_of, [("P1", "O83.3", "2022-01-01", "ICD10"), ("P1", "O83.3", "soon", "ICD10"), (None, "O83.3", "2022-01-01", "ICD10")])
    event = M.EventDefinition("birth", "ICD10", ("O83",), -270, 90)
    assert windows_of(M.mask_intervals(long, [event])) == [("P1", "birth", "2021-04-06", "2022-04-01")]


@pytest.mark.parametrize("listed, code, raw, strict", [
    ("O83", "O83.3", True, True), ("O83", "O83", True, False), ("O83", "O84.1", False, False), ("O00.1", "O00.10", True, False),
    ("O03.*", "O03.4", True, True), ("O03.*", "O03", False, False), ("O", "O83.3", False, False), ("O", "O", True, False)])
def test_event_codes(long_of, listed, code, raw, strict):
    long = marks(long_of, [("P1", code, "2022-01-01", "ICD10"), ("P2", code, "2022-01-01", "OTHER")])
    event = M.EventDefinition("e", "ICD10", (listed,))
    assert M.event_code_select(long, [event]).count() == int(raw)
    assert M.event_code_select(long, [event], raw_prefix=False).count() == int(strict)


def test_row_marks_each_event_once(long_of):
    long = marks(long_of, [("P1", "O03.4", "2022-01-01", "ICD10")])
    events = [M.EventDefinition("a", "ICD10", ("O03", "O03.*", "O03.4")), M.EventDefinition("b", "ICD10", ("O0",))]
    assert sorted(r.event_type for r in M.event_code_select(long, events).collect()) == ["a", "b"]


def test_unmatched_events_are_named(long_of):
    long = marks(long_of, [("P1", "O03.4", "2022-01-01", "ICD10")])
    events = [M.EventDefinition("a", "ICD10", ("O03",)), M.EventDefinition("none", "ICD10", ("Z99",))]
    intervals = M.mask_intervals(long, events)
    assert [r[0] for r in M.events_without_windows(intervals, events).collect()] == ["none"]
    empty = M.mask_intervals(long, events[1:])
    assert empty.count() == 0 and tuple(empty.columns) == M.INTERVAL_COLUMNS


def spans(spark, rows):
    return spark.createDataFrame([(s, e, DAY(a), DAY(b)) for s, e, a, b in rows],
                                 "sample_ID string, event_type string, window_start date, window_end date")


def test_merging(spark):
    df = spans(spark, [
        ("P1", "e", "2022-01-01", "2022-01-10"), ("P1", "e", "2022-01-10", "2022-01-12"),  # share a day
        ("P1", "e", "2022-01-13", "2022-01-14"),  # the next day: apart
        ("P1", "e", "2022-03-01", "2022-03-30"), ("P1", "e", "2022-03-05", "2022-03-06"), ("P1", "e", "2022-03-29", "2022-04-02"),
        ("P1", "e", "2022-01-01", "2022-01-10"), ("P1", "f", "2022-01-05", "2022-01-06"), ("P2", "e", "2022-01-05", "2022-01-06")])
    assert windows_of(M.merge_intervals(df)) == [
        ("P1", "e", "2022-01-01", "2022-01-12"), ("P1", "e", "2022-01-13", "2022-01-14"),
        ("P1", "e", "2022-03-01", "2022-04-02"), ("P1", "f", "2022-01-05", "2022-01-06"), ("P2", "e", "2022-01-05", "2022-01-06")]


def random_case(seed):
    rng = random.Random(seed)
    start = DAY("2019-12-20")
    day = lambda: start + datetime.timedelta(days=rng.randint(0, 400))
    spans_ = []
    for _ in range(120):
        a = day()
        spans_.append((f"P{rng.randint(1, 5)}", rng.choice("ef"), a, a + datetime.timedelta(days=rng.choice([-1, 0, 1, 5, 40, 200]) if rng.random() < .3 else rng.randint(0, 6))))
    rows = [(f"P{rng.randint(1, 6)}", i, day()) for i in range(1500)]
    return spans_, rows


@pytest.mark.parametrize("seed", [1, 2])
def test_masking_equals_brute_force(spark, seed):
    windows, rows = random_case(seed)
    intervals = spark.createDataFrame(windows, "sample_ID string, event_type string, window_start date, window_end date")
    long = spark.createDataFrame(rows, "sample_ID string, value int, occurrence_date date").withColumn(
        "phenotype", F.when(F.col("value") % 2 == 0, "even").otherwise("odd"))

    def hit(sample, day, types):
        return any(s == sample and t in types and a <= day <= b for s, t, a, b in windows)

    kept = {r.value for r in M.apply_mask(long, intervals, ["e"]).collect()}
    assert kept == {v for s, v, d in rows if not hit(s, d, "e")}
    kept = {r.value for r in M.apply_mask(long, intervals, ["e", "f"]).collect()}
    assert kept == {v for s, v, d in rows if not hit(s, d, "ef")}
    batch = {r.value for r in M.apply_mask_batch(long, intervals, {"even": ["f"], "other": ["e"]}).collect()}
    assert batch == {v for s, v, d in rows if v % 2 or not hit(s, d, "f")}


def test_ends_are_inclusive_and_bad_dates_stay(spark, long_of):
    intervals = spans(spark, [("P1", "e", "2022-01-10", "2022-02-20")])
    dates = ["2022-01-09", "2022-01-10", "2022-02-20", "2022-02-21", "soon", None]
    long = long_of([("P1", "quantitative", "X", str(i), d) for i, d in enumerate(dates)] + [("P2", "quantitative", "X", "9", "2022-01-15")])
    kept = M.apply_mask(long, intervals, ["e"])
    assert sorted(r.value for r in kept.collect()) == ["0", "3", "4", "5", "9"]
    assert kept.columns == long.columns
    assert M.apply_mask(long, intervals, ["other"]).count() == 7
    assert M.apply_mask(long, intervals, ["e"], has_dates=False).count() == 7


def test_text_intervals_and_checks(spark, long_of):
    text = spark.createDataFrame([("P1", "e", "2022-01-10", "2022-01-20"), ("P1", "e", "bad", "2022-03-01")],
                                 "sample_ID string, event_type string, window_start string, window_end string")
    long = long_of([("P1", "quantitative", "X", "1", "2022-01-15"), ("P1", "quantitative", "X", "2", "2022-02-15")])
    assert [r.value for r in M.apply_mask(long, text, ["e"]).collect()] == ["2"]
    with pytest.raises(ValueError):
        M.apply_mask(long, text.drop("window_end"), ["e"])
    with pytest.raises(ValueError):
        M.apply_mask(long.drop("occurrence_date"), text, ["e"])


def test_synthetic_dates_can_be_spared(spark, long_of):
    intervals = spans(spark, [("P1", "e", "2022-01-10", "2022-01-20")])
    long = long_of([("P1", "quantitative", "X", v, "2022-01-15") for v in "12"]).withColumn("date_is_synthetic", F.col("value") == "2")
    assert M.apply_mask(long, intervals, ["e"]).count() == 0
    assert [r.value for r in M.apply_mask(long, intervals, ["e"], spare_synthetic=True).collect()] == ["2"]
    batch = M.apply_mask_batch(long, intervals, {"X": ["e"]}, spare_synthetic=True)
    assert [r.value for r in batch.collect()] == ["2"]


def test_mask_join_has_equality_keys(spark, long_of):
    long = long_of([("P1", "quantitative", "X", "1", "2022-01-15")])
    df = M.apply_mask(long, spans(spark, [("P1", "e", "2022-01-10", "2022-01-20")]), ["e"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "NestedLoop" not in plan and "node" in plan


def test_events_from_a_code_table(spark, long_of):
    table = spark.createDataFrame([("First Trimester", "O03"), ("First Trimester", " O03 "), ("Third", "O80"), (" ", "O1"),
                                   ("Third", None), ("nan", "O2")], "TRIMESTER string, ICD10 string")
    events = M.event_definitions_from_table(table)
    assert sorted(map(tuple, events.collect())) == [("first_trimester", "O03", "ICD10", -270, 90), ("third", "O80", "ICD10", -270, 90)]
    with pytest.raises(ValueError):
        M.event_definitions_from_table(table.drop("ICD10"))
    long = marks(long_of, [("P1", "O03.4", "2022-01-01", "ICD10"), ("P1", "O80", "2022-06-01", "ICD10"), ("P1", "O03.4", "2022-01-01", "ICD9")])
    assert [r.event_type for r in M.event_code_select(long, events).orderBy("event_type").collect()] == ["first_trimester", "third"]
    assert M.events_without_windows(M.mask_intervals(long.where("value = 'O80'"), events), events).first()[0] == "first_trimester"


def test_a_window_of_any_length_costs_few_rows(spark):
    lengths = [1, 2, 31, 365, 1000, 36_500, 1_000_000]
    df = spark.createDataFrame([(n, off) for n in lengths for off in (0, 1, 17, -900)], "n int, off int").withColumns(
        {"a": F.date_add(F.lit("1990-01-01").cast("date"), F.col("off")), "b": F.date_add(F.lit("1990-01-01").cast("date"), F.col("off") + F.col("n") - 1)})
    found = df.select("n", M._nodes(F.col("a"), F.col("b")).alias("nodes"), F.unix_date("a").alias("low"), F.unix_date("b").alias("high")).collect()
    for r in found:
        runs = sorted((node.node << node.level, (node.node + 1) << node.level) for node in r.nodes)
        assert len(runs) <= 2 * max(1, r.n.bit_length())
        assert runs[0][0] == r.low and runs[-1][1] == r.high + 1 and all(x[1] == y[0] for x, y in zip(runs, runs[1:]))


def test_lifelong_windows(spark, long_of):
    intervals = spans(spark, [("P1", "e", "1000-01-01", "9999-12-31"), ("P2", "e", "1969-12-30", "1970-01-02")])
    rows = [("P1", "quantitative", "X", "1", "2022-01-15"), ("P1", "quantitative", "X", "2", "0950-02-15"), *[
        ("P2", "quantitative", "X", str(i), d) for i, d in enumerate(["1969-12-29", "1969-12-30", "1970-01-01", "1970-01-02", "1970-01-03"], 3)]]
    assert sorted(r.value for r in M.apply_mask(long_of(rows), intervals, ["e"]).collect()) == ["2", "3", "7"]


def test_a_window_is_filed_in_two_places_at_most(spark):
    """days are looked up in a few sizes of runs; whatever its length, a window lies in the runs it is filed under."""
    df = spark.createDataFrame([(n, off) for n in (1, 16, 17, 365, 36_500, 3_000_000) for off in (0, 7, -900)], "n int, off int").withColumns(
        {"a": F.date_add(F.lit("1970-01-01").cast("date"), F.col("off")), "b": F.date_add(F.lit("1970-01-01").cast("date"), F.col("off") + F.col("n") - 1)})
    for r in df.select(M._places(F.col("a"), F.col("b")).alias("places"), F.unix_date("a").alias("low"), F.unix_date("b").alias("high")).collect():
        runs = [(p.node << p.level, (p.node + 1) << p.level) for p in r.places]
        assert 1 <= len(runs) <= 2 and len({p.level for p in r.places}) == 1 and r.places[0].level in M.LEVELS
        assert min(low for low, _ in runs) <= r.low and r.high < max(end for _, end in runs)


def test_windows_are_merged_once(spark, long_of):
    """F4 to F7: sizes and windows come from one written table, so the windows are not derived twice."""
    long = long_of([("P1", "quantitative", "X", "1", "2022-01-15")])
    intervals = spans(spark, [("P1", "e", "2022-01-10", "2022-01-20")])
    for df in (M.apply_mask(long, intervals, ["e"]), M.apply_mask_batch(long, intervals, {"X": ["e"]})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and df.count() == 0
