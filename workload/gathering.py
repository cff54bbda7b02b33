"""Gathering, stacking and chunking."""

from pyspark.sql import functions as F

from cohortweave.functions.dates import age_at_reference
from cohortweave.operators.categorical import CategoricalSpec, categorical
from cohortweave.operators.chunks import cohort_chunks
from cohortweave.operators.coded import basic_coded
from cohortweave.operators.gather import gather_both, gather_long, gather_wide, union_wide
from cohortweave.operators.quant import quantitative_summary
from cohortweave.runtime import scratch_path
from cohortweave.sources.sinks import read_chunks, write_chunks
from workload.base import (
    CODES, EVENTS, ORDERS, cat_segment, day_text, long_codes, long_events, long_orders, query, rounded, table)


def parts(spark, sf_dir):
    orders = quantitative_summary(long_orders(spark, sf_dir), "TP", ["mean", "max"]).select(
        "sample_ID", rounded("TP_mean"), "TP_max")
    events = quantitative_summary(long_events(spark, sf_dir), "EVENT", ["count"])
    code = basic_coded(long_codes(spark, sf_dir), "N24.4")
    segment = categorical(cat_segment(spark, sf_dir), CategoricalSpec("SEGMENT", one_hot=True))
    return [orders, events, code, segment]


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
FLAGS = [f'"SEGMENT_{s}"' for s in SEGMENTS]
PARTS = f"""WITH o AS (SELECT "sample_ID", ROUND(avg(value), 6) AS "TP_mean", max(value) AS "TP_max" FROM {ORDERS} GROUP BY 1),
  k AS (SELECT "sample_ID", count(*) AS "EVENT_count" FROM {EVENTS} GROUP BY 1),
  d AS (SELECT "sample_ID", 1 AS "N24.4" FROM {CODES} WHERE value = 'N24.4' GROUP BY 1),
  g AS (SELECT CAST(c_custkey AS VARCHAR) AS "sample_ID",
        {', '.join(f"CAST(c_mktsegment = '{s}' AS INT) AS {c}" for s, c in zip(SEGMENTS, FLAGS))} FROM customer)"""


@query("gather_wide", f"""{PARTS} SELECT "sample_ID", "TP_mean", "TP_max", "EVENT_count", "N24.4", {', '.join(FLAGS)}
  FROM o FULL JOIN k USING ("sample_ID") FULL JOIN d USING ("sample_ID") FULL JOIN g USING ("sample_ID")""")
def _gather_wide(spark, sf_dir):
    return gather_wide(parts(spark, sf_dir))


LONG = f"""{PARTS} SELECT "sample_ID", 'TP_mean' AS phenotype, "TP_mean" AS value FROM o
  UNION ALL SELECT "sample_ID", 'TP_max', "TP_max" FROM o UNION ALL SELECT "sample_ID", 'EVENT_count', "EVENT_count" FROM k
  UNION ALL SELECT "sample_ID", 'N24.4', "N24.4" FROM d
  {' '.join(f'''UNION ALL SELECT "sample_ID", 'SEGMENT_{s}', {c} FROM g''' for s, c in zip(SEGMENTS, FLAGS))}"""


@query("gather_long", LONG)
def _gather_long(spark, sf_dir):
    return gather_long(parts(spark, sf_dir)).withColumn("value", F.col("value").cast("double"))


@query("gather_both", f"""SELECT "sample_ID", phenotype, CAST(value AS DOUBLE) AS long_value, CAST(value AS DOUBLE) AS wide_value FROM ({LONG})""")
def _gather_both(spark, sf_dir):
    """Both forms cell by cell: what either holds stands beside what the other has there."""
    wide, long = gather_both(parts(spark, sf_dir), sort=False)
    names = [n for n in wide.columns if n != "sample_ID"]
    cells = wide.select("sample_ID", *[F.col(f"`{n}`").cast("double").alias(n) for n in names]).unpivot(
        "sample_ID", [F.col(f"`{n}`") for n in names], "phenotype", "wide_value").where("wide_value IS NOT NULL")
    long = long.withColumn("long_value", F.col("value").cast("double")).drop("value")
    return long.join(cells, ["sample_ID", "phenotype"], "full")


@query("union_wide", """SELECT CAST(c_custkey AS VARCHAR) AS "sample_ID", c_mktsegment AS segment, NULL AS brand,
  c_acctbal AS balance FROM customer
  UNION ALL SELECT 'P' || CAST(p_partkey AS VARCHAR), NULL, p_brand, p_retailprice FROM part
  UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), NULL, NULL, s_acctbal FROM supplier""")
def _union_wide(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("sample_ID"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"))
    products = table(spark, sf_dir, "part").select(
        F.col("p_retailprice").alias("balance"), F.col("p_brand").alias("brand"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("sample_ID"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sample_ID"), F.col("s_acctbal").alias("balance"))
    return union_wide([customers, products, suppliers])


@query("cohort_chunks", """WITH r AS (SELECT s, ROW_NUMBER() OVER (ORDER BY s) AS place, COUNT(*) OVER () AS n
    FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS s FROM orders))
  SELECT s AS "sample_ID", o_orderkey, lpad(CAST((place - 1) // 100 + 1 AS VARCHAR),
    CAST(length(CAST((n + 99) // 100 AS VARCHAR)) AS INT), '0') AS chunk_id
  FROM orders JOIN r ON CAST(o_custkey AS VARCHAR) = s""")
def _cohort_chunks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("sample_ID"), "o_orderkey")
    return cohort_chunks(orders, 100)


@query("chunk_round_trip", f"""WITH r AS (SELECT s, ROW_NUMBER() OVER (ORDER BY s) AS place, COUNT(*) OVER () AS n
    FROM (SELECT DISTINCT "sample_ID" AS s FROM {ORDERS}))
  SELECT "sample_ID", value, CAST(occurrence_date AS VARCHAR) AS occurrence_date, lpad(CAST((place - 1) // 40 + 1 AS VARCHAR),
    CAST(length(CAST((n + 39) // 40 AS VARCHAR)) AS INT), '0') AS chunk_id FROM {ORDERS} JOIN r ON "sample_ID" = s""")
def _chunk_round_trip(spark, sf_dir):
    """Split, written a folder per chunk, every second chunk reread by itself and both halves stacked."""
    chunked = cohort_chunks(long_orders(spark, sf_dir), 40).select("sample_ID", "value", "occurrence_date", "chunk_id")
    path = scratch_path(spark, "chunks")
    write_chunks(chunked, path, "parquet")
    names = sorted(r[0] for r in read_chunks(spark, path, chunked.schema).select("chunk_id").distinct().collect())
    halves = [read_chunks(spark, path, chunked.schema, names[i::2]) for i in range(2)]
    return union_wide(halves).withColumn("occurrence_date", day_text("occurrence_date"))


@query("age_at_reference", """SELECT l_orderkey, l_linenumber, CAST(2024 - year(l_shipdate)
  - CAST((month(l_shipdate), day(l_shipdate)) > (2, 28) AS INT) AS INT) AS age FROM lineitem""")
def _age_at_reference(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return age_at_reference(items, "l_shipdate", "2024-02-28").drop("l_shipdate")
