"""Readers, writers, filters and the long layout."""

from pyspark.sql import functions as F

from cohortweave.functions.values import coerce_numeric as coerce
from cohortweave.functions.values import normalize_nulls
from cohortweave.functions.vocabulary import normalize_data_type, route_by_data_type
from cohortweave.operators import long as L
from cohortweave.operators.report import phenotype_report
from cohortweave.runtime import scratch_path
from cohortweave.sources.delimited import scan_delimited, scan_long, scan_roster
from cohortweave.sources.sinks import write_long, write_long_buckets, write_wide
from workload.base import (
    CODES, EVENTS, MESSY_SQL, ORDERS, PRIORITY, SEGMENT, cat_priority, cat_segment, code_records, day_text, long_codes,
    long_events, long_orders, messy_events, query, table)

# What reading the messy text should leave.
CLEAN_SQL = f"""SELECT event_id, patient, test,
  CASE WHEN reading IN ('NA', 'n/a', '') THEN NULL ELSE reading END AS reading,
  CASE WHEN visit = 'NULL' THEN NULL ELSE visit END AS visit FROM {MESSY_SQL}"""


@query("scan_delimited", f"""SELECT CAST(event_id AS VARCHAR) AS event_id, patient, test, reading, visit
  FROM ({CLEAN_SQL})""")
def _scan_delimited(spark, sf_dir):
    path = scratch_path(spark, "events") + ".tsv"
    write_wide(messy_events(spark, sf_dir), path)
    return scan_delimited(spark, path)


@query("scan_delimited_whitespace", """SELECT CAST(o_orderkey AS VARCHAR) AS "order", o_orderstatus AS status,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""")
def _scan_delimited_whitespace(spark, sf_dir):
    # Columns padded with blanks, read with a separator that is a regular expression.
    path = scratch_path(spark, "orders-padded")
    orders = table(spark, sf_dir, "orders")
    line = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 12, " "), F.lit("  "), "o_orderstatus",
                    F.lit("   "), F.to_date("o_orderdate").cast("string"))
    orders.select(line.alias("   order status day")).write.csv(
        path, header=True, quote="", escape="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return scan_delimited(spark, path, sep="whitespace")


@query("normalize_nulls", CLEAN_SQL)
def _normalize_nulls(spark, sf_dir):
    return normalize_nulls(messy_events(spark, sf_dir))


@query("scan_long", """SELECT CAST(user_id AS VARCHAR) AS "sample_ID", CAST(NULL AS VARCHAR) AS data_type, event_type AS phenotype,
  CAST(value AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS occurrence_date FROM events""")
def _scan_long(spark, sf_dir):
    path = scratch_path(spark, "partial-long") + ".tsv"
    write_wide(long_events(spark, sf_dir).select("sample_ID", "phenotype", "value"), path)
    return scan_long(spark, path)


@query("scan_roster", """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS "sample_ID" FROM orders""")
def _scan_roster(spark, sf_dir):
    path = scratch_path(spark, "roster")
    padded = F.concat(F.lit("  "), F.col("o_custkey").cast("string"), F.lit("\t"))
    lines = table(spark, sf_dir, "orders").select(F.explode(F.array(padded, F.lit("  "))).alias("line"))
    lines.write.text(path)
    return scan_roster(spark, path)


@query("write_long", f"""SELECT "sample_ID", data_type, value AS phenotype, value, source,
  CAST(occurrence_date AS VARCHAR) AS occurrence_date FROM {CODES}""")
def _write_long(spark, sf_dir):
    path = scratch_path(spark, "codes-long")
    write_long(long_codes(spark, sf_dir), path)
    return spark.read.parquet(path).withColumn("occurrence_date", day_text("occurrence_date"))


@query("write_long_buckets", f"""SELECT "sample_ID", COUNT(*) AS n_rows, COUNT(DISTINCT value) AS n_codes, MIN(value) AS first_code,
  CAST(MAX(occurrence_date) AS VARCHAR) AS last_day FROM {CODES} GROUP BY 1""")
def _write_long_buckets(spark, sf_dir):
    """Written once by sample; what is asked of a sample afterwards needs no exchange."""
    path = scratch_path(spark, "codes-buckets")
    back = write_long_buckets(long_codes(spark, sf_dir), path.rsplit("/", 1)[1].replace("-", "_"), path, 16)
    summary = back.groupBy("sample_ID").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("value").alias("n_codes"), F.min("value").alias("first_code"),
        F.max("occurrence_date").alias("last_day"))
    return summary.withColumn("last_day", day_text("last_day"))


@query("write_wide", """SELECT CAST(c_custkey AS VARCHAR) AS "sample_ID", c_name, c_mktsegment,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal FROM customer""")
def _write_wide(spark, sf_dir):
    path = scratch_path(spark, "customers-wide") + ".tsv"
    write_wide(table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("sample_ID"), "c_name", "c_mktsegment", "c_acctbal"), path)
    return scan_delimited(spark, path)


@query("phenotype_report", f"""SELECT data_type, phenotype, COUNT(*) AS n_rows, COUNT(value) AS n_numeric,
  COUNT(DISTINCT "sample_ID") AS n_samples, phenotype || '_mean' AS columns FROM {EVENTS} GROUP BY 1, 2""")
def _phenotype_report(spark, sf_dir):
    types = ("click", "error", "purchase", "signup", "view")
    report = phenotype_report(long_events(spark, sf_dir), {t: [f"{t}_mean"] for t in types})
    return report.withColumn("n_numeric", F.col("n_numeric").cast("bigint"))


@query("glob_row_filter", """SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
  WHERE (o_orderpriority LIKE '%-%H' OR o_orderpriority LIKE '1-%' OR o_orderpriority = '5-LOW')
  AND (o_orderstatus = 'F' OR o_orderstatus NOT IN ('F', 'P'))""")
def _glob_row_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return L.glob_row_filter(orders, {
        "o_orderpriority": ["*-*H", "1-*", "5-LOW"], "o_orderstatus": ["F", "[!FP]"], "no_such_column": ["x"]})


@query("code_subsample", f"""SELECT "sample_ID", value FROM {CODES}
  WHERE regexp_full_match(value, 'A1[0-5]\\.[13]') OR starts_with(value, 'R5') OR value = 'N24.4'""")
def _code_subsample(spark, sf_dir):
    rows = long_codes(spark, sf_dir).select("sample_ID", "value")
    return L.code_subsample(rows, "value", ["A1[0-5].[13]", "R5*", "N24.4"])


@query("sample_allow_list", f"""SELECT "sample_ID", value FROM {ORDERS}
  WHERE "sample_ID" IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""")
def _sample_allow_list(spark, sf_dir):
    allowed = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return L.sample_allow_list(long_orders(spark, sf_dir).select("sample_ID", "value"), allowed)


@query("build_long", f"""SELECT patient AS "sample_ID", 'quantitative' AS data_type, 'READING' AS phenotype,
  reading AS value, COALESCE(visit, '2024-02-01') AS occurrence_date FROM ({CLEAN_SQL}) WHERE reading IS NOT NULL""")
def _build_long(spark, sf_dir):
    return L.build_long(
        normalize_nulls(messy_events(spark, sf_dir)), sample_id_col="patient", value_col="reading",
        data_type="quantitative", phenotype="READING", date_col="visit", reference_date="2024-02-01")


@query("fill_occurrence_date", f"""SELECT event_id, COALESCE(visit, '2024-02-01') AS occurrence_date,
  CAST(visit IS NULL AS INT) AS date_is_synthetic FROM ({CLEAN_SQL})""")
def _fill_occurrence_date(spark, sf_dir):
    rows = normalize_nulls(messy_events(spark, sf_dir))
    return L.fill_occurrence_date(rows, "visit", "2024-02-01").select(
        "event_id", "occurrence_date", F.col("date_is_synthetic").cast("int").alias("date_is_synthetic"))


@query("explode_codes", f"""SELECT "sample_ID", data_type, value AS phenotype, value,
  CAST(occurrence_date AS VARCHAR) AS occurrence_date FROM {CODES}
  WHERE source = 'DX_F' AND value IN ('A10.1', 'N24.4', 'R50.7')""")
def _explode_codes(spark, sf_dir):
    return L.explode_codes(
        code_records(spark, sf_dir), value_col="code", sample_id_col="patient", date_col="day",
        filters={"vocabulary": ["DX_F"]}, subsample=["A10.1", "N24.4", "R50.7"],
    ).withColumn("occurrence_date", day_text("occurrence_date"))


@query("coerce_numeric", f"""SELECT event_id, CASE WHEN regexp_full_match(trim(reading), '[0-9.]+')
  THEN TRY_CAST(trim(reading) AS DOUBLE) END AS value_num FROM {MESSY_SQL}""")
def _coerce_numeric(spark, sf_dir):
    return coerce(messy_events(spark, sf_dir), "reading").select("event_id", "value_num")


@query("route_by_data_type", f"""SELECT family, phenotype, COUNT(*) AS n_rows FROM (
  SELECT 'quantitative' AS family, phenotype FROM {EVENTS}
  UNION ALL SELECT 'categorical', phenotype FROM {SEGMENT}
  UNION ALL SELECT 'categorical', phenotype FROM {PRIORITY}) GROUP BY 1, 2""")
def _route_by_data_type(spark, sf_dir):
    kinds = F.when(F.col("phenotype") == "view", "Vitals").when(F.col("phenotype") == "click", "MEASUREMENTS")
    events = long_events(spark, sf_dir).withColumn("data_type", kinds.otherwise("Quantitative"))
    parts = [events, long_codes(spark, sf_dir).drop("source"), cat_segment(spark, sf_dir), cat_priority(spark, sf_dir)]
    everything = parts[0].select("data_type", "phenotype")
    for part in parts[1:]:
        everything = everything.unionByName(part.select("data_type", "phenotype"))
    routed = [route_by_data_type(everything, f).withColumn("family", F.lit(f)) for f in ("quantitative", "categorical")]
    return routed[0].unionByName(routed[1]).groupBy("family", "phenotype").agg(F.count(F.lit(1)).alias("n_rows"))


@query("distinct_codes", f"""SELECT DISTINCT value AS code FROM {CODES}
  WHERE source = 'DX_O' AND (value LIKE 'N%.1' OR value LIKE 'R_0.%')""")
def _distinct_codes(spark, sf_dir):
    return L.distinct_codes(code_records(spark, sf_dir), "code", {"vocabulary": ["*O"]}, ["N*.1", "R?0.*"])


@query("normalize_data_type", """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'ICD10'
  WHEN 'N' THEN CASE l_linestatus WHEN 'F' THEN 'measurements' ELSE 'ICD9' END ELSE 'CPT' END AS data_type FROM lineitem""")
def _normalize_data_type(spark, sf_dir):
    raw = (
        F.when(F.col("l_returnflag") == "A", F.when(F.col("l_linestatus") == "F", " ICD-10-CM ").otherwise("icd10"))
        .when(F.col("l_returnflag") == "N", F.when(F.col("l_linestatus") == "F", "Lab").otherwise("ICD09\t"))
        .otherwise(" CPT"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", normalize_data_type(raw).alias("data_type"))
