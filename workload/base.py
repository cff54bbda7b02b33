"""Registry and the adapters that lay the given tables out as clinical tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.operators.long import build_long

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(column: str | Column, digits: int = 6) -> Column:
    name = column if isinstance(column, str) else None
    out = F.round(F.col(f"`{name}`") if name else column, digits)
    return out.alias(name) if name else out


def day_text(name: str) -> Column:
    return F.date_format(F.col(name), "yyyy-MM-dd").alias(name)


# ---- measurements: events per user and type ------------------------------------------------------

def long_events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("sample_ID"), F.lit("quantitative").alias("data_type"),
        F.col("event_type").alias("phenotype"), "value", F.to_date("ts").alias("occurrence_date"))


EVENTS = """(SELECT CAST(user_id AS VARCHAR) AS sample_ID, 'quantitative' AS data_type, event_type AS phenotype,
  value, CAST(ts AS DATE) AS occurrence_date FROM events)"""

# ---- the same as text, with the blemishes of hand-kept tables --------------------------------------

MESSY_SQL = """(SELECT event_id, CAST(user_id AS VARCHAR) AS patient, event_type AS test,
  CASE WHEN value < 2 THEN 'NA' WHEN value < 3 THEN 'n/a' WHEN value < 4 THEN '' WHEN value < 5 THEN '7d'
       WHEN value < 6 THEN 'high' WHEN value < 7 THEN ' ' || CAST(value AS VARCHAR) || ' '
       ELSE CAST(value AS VARCHAR) END AS reading,
  CASE WHEN value > 60 THEN 'NULL' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS visit FROM events)"""


def messy_events(spark, sf_dir) -> DataFrame:
    value, text = F.col("value"), F.col("value").cast("string")
    reading = (
        F.when(value < 2, "NA").when(value < 3, "n/a").when(value < 4, "").when(value < 5, "7d")
        .when(value < 6, "high").when(value < 7, F.concat(F.lit(" "), text, F.lit(" "))).otherwise(text))
    visit = F.when(value > 60, "NULL").otherwise(F.to_date("ts").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("patient"), F.col("event_type").alias("test"),
        reading.alias("reading"), visit.alias("visit"))


# ---- order values: one measurement per order ------------------------------------------------------

def long_orders(spark, sf_dir) -> DataFrame:
    return build_long(
        table(spark, sf_dir, "orders"), sample_id_col="o_custkey", value_col="o_totalprice",
        data_type="quantitative", phenotype="TOTALPRICE", date_col="o_orderdate")


ORDERS = """(SELECT CAST(o_custkey AS VARCHAR) AS sample_ID, 'quantitative' AS data_type, 'TOTALPRICE' AS phenotype,
  o_totalprice AS value, CAST(o_orderdate AS DATE) AS occurrence_date FROM orders)"""

# ---- codes: letter, two digits, a dot and a digit, in two sources ----------------------------------

def code_records(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_linenumber", "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    code = F.concat("l_returnflag", F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("."),
                    F.col("l_linenumber").cast("string"))
    return (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("o_custkey").cast("string").alias("patient"), code.alias("code"),
                F.when(F.col("l_linestatus") == "F", "DX_F").otherwise("DX_O").alias("vocabulary"),
                F.to_date("l_shipdate").alias("day")))


def long_codes(spark, sf_dir) -> DataFrame:
    return code_records(spark, sf_dir).select(
        F.col("patient").alias("sample_ID"), F.lit("coded").alias("data_type"), F.col("code").alias("phenotype"),
        F.col("code").alias("value"), F.col("day").alias("occurrence_date"), F.col("vocabulary").alias("source"))


CODES = """(SELECT CAST(o_custkey AS VARCHAR) AS sample_ID, 'coded' AS data_type,
  l_returnflag || lpad(CAST(p_size AS VARCHAR), 2, '0') || '.' || CAST(l_linenumber AS VARCHAR) AS value,
  CASE WHEN l_linestatus = 'F' THEN 'DX_F' ELSE 'DX_O' END AS source, CAST(l_shipdate AS DATE) AS occurrence_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

# ---- categories -----------------------------------------------------------------------------------

def cat_priority(spark, sf_dir) -> DataFrame:
    return build_long(
        table(spark, sf_dir, "orders"), sample_id_col="o_custkey", value_col="o_orderpriority",
        data_type="categorical", phenotype="PRIORITY", date_col="o_orderdate")


PRIORITY = """(SELECT CAST(o_custkey AS VARCHAR) AS sample_ID, 'categorical' AS data_type, 'PRIORITY' AS phenotype,
  o_orderpriority AS value, CAST(o_orderdate AS DATE) AS occurrence_date FROM orders)"""


def cat_segment(spark, sf_dir) -> DataFrame:
    return build_long(
        table(spark, sf_dir, "customer"), sample_id_col="c_custkey", value_col="c_mktsegment",
        data_type="demographic", phenotype="SEGMENT", reference_date="2024-01-01")


SEGMENT = """(SELECT CAST(c_custkey AS VARCHAR) AS sample_ID, 'demographic' AS data_type, 'SEGMENT' AS phenotype,
  c_mktsegment AS value, DATE '2024-01-01' AS occurrence_date FROM customer)"""

# ---- roster ---------------------------------------------------------------------------------------

def roster(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("sample_ID"))


ROSTER = "(SELECT CAST(c_custkey AS VARCHAR) AS sample_ID FROM customer)"
