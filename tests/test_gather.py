import datetime

import pytest
from conftest import by_sample
from pyspark.sql import functions as F

from cohortweave.functions.dates import age_at_reference
from cohortweave.operators.chunks import cohort_chunks
from cohortweave.operators.gather import gather_both, gather_long, gather_wide, union_wide
from cohortweave.sources.sinks import read_chunks, write_chunks


@pytest.fixture
def tables(spark):
    return [spark.createDataFrame([("P1", 1.5), ("P2", None)], "sample_ID string, `BMI.mean` double"),
            spark.createDataFrame([("P2", 1, "a b"), ("P3", 0, None)], "sample_ID string, T2D int, note string")]


def test_wide(tables):
    wide = gather_wide(tables)
    assert wide.columns == ["sample_ID", "BMI.mean", "T2D", "note"]
    assert [f.dataType.simpleString() for f in wide.schema] == ["string", "double", "int", "string"]
    assert list(map(tuple, wide.collect())) == [("P1", 1.5, None, None), ("P2", None, 1, "a b"), ("P3", None, 0, None)]


def test_long_has_own_cells_only(tables):
    assert list(map(tuple, gather_long(tables).collect())) == [
        ("P1", "BMI.mean", "1.5"), ("P2", "BMI.mean", None), ("P2", "T2D", "1"), ("P2", "note", "a b"),
        ("P3", "T2D", "0"), ("P3", "note", None)]


def test_both(tables):
    wide, long = gather_both(tables)
    assert wide.count() == 3 and long.count() == 6


def test_unusable_tables(spark, tables):
    alien = spark.createDataFrame([(1,)], "x int")
    assert gather_wide([*tables, alien]).count() == 3
    assert gather_wide([]) is None
    with pytest.raises(ValueError):
        gather_wide([alien])
    with pytest.raises(ValueError):
        gather_wide([tables[0], tables[0]])


def test_sample_twice_in_a_table_is_an_error(spark, tables):
    twice = spark.createDataFrame([("P1", 1), ("P1", 2)], "sample_ID string, z int")
    with pytest.raises(Exception, match="several rows"):
        gather_wide([tables[0], twice]).collect()


def test_many_tables_in_one_shuffle(spark):
    parts = [spark.createDataFrame([(f"P{i % 3}", i)], f"sample_ID string, c{i} int") for i in range(70)]
    wide = gather_wide(parts, sort=False)
    assert wide.count() == 3
    row = {r.sample_ID: r for r in wide.collect()}["P1"]
    assert row.c1 == 1 and row.c2 is None and row.c67 == 67
    assert wide._jdf.queryExecution().sparkPlan().toString().count("Join") == 0


def test_union(spark):
    a = spark.createDataFrame([("P2", 1)], "sample_ID string, x int")
    b = spark.createDataFrame([("u", "P1")], "y string, sample_ID string")
    assert list(map(tuple, union_wide([a, b]).collect())) == [("P1", None, "u"), ("P2", 1, None)]
    assert [r.sample_ID for r in union_wide([a, b], no_sort=True).collect()] == ["P2", "P1"]
    with pytest.raises(ValueError):
        union_wide([])


@pytest.mark.parametrize("samples, size, sizes", [(25, 10, [10, 10, 5]), (3, 10, [3]), (12, 1, [1] * 12), (20, 10, [10, 10])])
def test_chunks(long_of, samples, size, sizes):
    ids = [f"S{i:03d}" for i in range(samples)]
    rows = [(s, "quantitative", "X", str(k), None) for s in reversed(ids) for k in range(3)]
    chunks = cohort_chunks(long_of(rows + [(None, "quantitative", "X", "1", None)]), size).collect()
    assert len(chunks) == 3 * samples
    of = {r.sample_ID: r.chunk_id for r in chunks}
    width = len(str(len(sizes)))
    assert of == {s: str(i // size + 1).zfill(width) for i, s in enumerate(ids)}


def test_chunk_arguments(long_of):
    long = long_of([("P1", "quantitative", "X", "1", None)])
    with pytest.raises(ValueError):
        cohort_chunks(long, 0)
    with pytest.raises(ValueError):
        cohort_chunks(long, 5, "absent")


def test_chunks_round_trip(long_of):
    rows = [(f"S{i:02d}", "quantitative", "X", str(i), None) for i in range(23)]
    chunked = cohort_chunks(long_of(rows), 5)
    parts = [chunked.where(f"chunk_id = '{c}'").select("sample_ID", "value") for c in "12345"]
    assert [tuple(r) for r in union_wide(parts).collect()] == [(r[0], r[3]) for r in rows]


def test_age(spark):
    born = [("a", "2000-02-29"), ("b", "2000-02-28"), ("c", "1990-12-31"), ("d", None), ("e", "unknown"), ("f", "2023-02-28 10:00:00")]
    df = spark.createDataFrame(born, "sample_ID string, born string")
    assert by_sample(age_at_reference(df, "born", "2023-02-28"), "age") == {"a": 22, "b": 23, "c": 32, "d": None, "e": None, "f": 0}
    typed = spark.createDataFrame([("a", datetime.date(2000, 3, 1))], "sample_ID string, born date")
    assert age_at_reference(typed, "born", "2023-03-01").first().age == 23


def test_chunk_round_trip(long_of, spark, tmp_path):
    from cohortweave.sources.sinks import read_chunks, write_chunks

    rows = [(f"P{i % 23:02d}", "quantitative", "X", str(i), "2020-01-01") for i in range(120)]
    chunked = cohort_chunks(long_of(rows), 2)
    write_chunks(chunked, str(tmp_path / "c"), "parquet")
    back = read_chunks(spark, str(tmp_path / "c"), chunked.schema)
    assert back.schema["chunk_id"].dataType.simpleString() == "string"
    assert sorted(map(tuple, back.select(*chunked.columns).collect())) == sorted(map(tuple, chunked.collect()))
    one = read_chunks(spark, str(tmp_path / "c"), chunked.schema, ["07"])
    assert {r.sample_ID for r in one.collect()} == {"P12", "P13"}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk_id" in plan or "chunk_id#" in plan.split("PartitionFilters")[1][:80]
    stacked = union_wide([read_chunks(spark, str(tmp_path / "c"), chunked.schema, [f"{i:02d}"]) for i in (12, 1, 2)])
    assert [r.sample_ID for r in stacked.select("sample_ID").distinct().orderBy("sample_ID").collect()] == ["P00", "P01", "P02", "P03", "P22"]


def test_hundreds_of_tables_of_many_types(spark):
    def table(i):
        value = [F.col("id") * i, F.concat(F.lit("x"), F.col("id")), F.expr("DATE '2020-01-01'"), F.create_map(F.lit("k"), F.col("id"))][i % 4]
        return spark.range(i % 2, 3, numPartitions=1).select(
            F.col("id").cast("string").alias("sample.ID"), value.alias(f"E{i}.1"), F.lit(i).cast("double").alias(f"it's `{i}`"))

    tables = [table(i) for i in range(120)]
    wide = gather_wide(tables, "sample.ID", sort=False)
    assert wide.columns == ["sample.ID"] + [c for t in tables for c in t.columns[1:]]
    assert [wide.schema[f"E{i}.1"].dataType for i in range(4)] == [tables[i].schema[f"E{i}.1"].dataType for i in range(4)]
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    # the plan grows with the tables, not with tables times columns
    assert len(plan) < 4 * 60 * len(gather_wide(tables[:2], "sample.ID", sort=False)._jdf.queryExecution().executedPlan().toString())
    rows = {r["sample.ID"]: r for r in wide.coalesce(1).collect()}
    assert set(rows) == {"0", "1", "2"}
    assert (rows["2"]["E4.1"], rows["2"]["E5.1"], rows["2"]["E7.1"], rows["2"]["it's `9`"]) == (8, "x2", {"k": 2}, 9.0)
    assert rows["0"]["E5.1"] is None and rows["0"]["it's `9`"] is None and rows["0"]["it's `8`"] == 8.0
    long = gather_long([t.drop("E3.1") for t in tables[:6]], "sample.ID", sort=False).collect()
    assert ("1", "it's `5`", "5.0") in {tuple(r) for r in long} and len(long) == 3 * 2 * 3 + 3 * 2 * 2 - 2


def test_listing_takes_few_tasks(spark, tmp_path):
    """a read of many chunk folders is listed by some tasks per core, not by a task per folder."""
    df = spark.range(150).select(F.format_string("%03d", "id").alias("chunk_id"), F.col("id").cast("string").alias("sample_ID"))
    write_chunks(df, str(tmp_path / "c"), "parquet")
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        back = read_chunks(spark, str(tmp_path / "c"), df.schema)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    stages = [i for job in status.getJobIdsForGroup("listing") for i in status.getJobInfo(job).stageIds]
    assert stages and sum(status.getStageInfo(i).numTasks for i in stages) <= 4 * spark.sparkContext.defaultParallelism
    assert back.count() == 150
