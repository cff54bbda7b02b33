"""Per-sample statistics and quantile bins."""

from pyspark.sql import functions as F

from cohortweave.operators import quant as N
from workload.base import EVENTS, ORDERS, long_events, long_orders, query, rounded

STAT_SQL = {
    "mean": "avg(value)", "median": "median(value)", "std": "stddev_samp(value)", "min": "min(value)",
    "max": "max(value)", "count": "count(value)", "squared": "pow(avg(value), 2)",
    "first": "arg_min(value, (occurrence_date, value))", "last": "arg_max(value, (occurrence_date, value))",
}


def _register(stat):
    # Few enough digits for sums in any order to agree, enough that means of two-digit values are no ties.
    digits = 6 if stat == "squared" else 9
    shown = STAT_SQL[stat] if stat == "count" else f"ROUND({STAT_SQL[stat]}, {digits})"

    @query(f"stat_{stat}", f"""SELECT "sample_ID", phenotype, {shown} AS {stat} FROM {EVENTS} GROUP BY 1, 2""")
    def run(spark, sf_dir):
        found = N.sample_stats(long_events(spark, sf_dir), [stat], ["sample_ID", "phenotype"])
        return found.select("sample_ID", "phenotype", stat if stat == "count" else rounded(stat, digits))


for _stat in N.STATS:
    _register(_stat)

# The median alone, over larger samples.
@query("stat_median_large_groups", f"""SELECT "sample_ID", ROUND(median(value), 6) AS median FROM {ORDERS} GROUP BY 1""")
def _stat_median_large_groups(spark, sf_dir):
    found = N.sample_stats(long_orders(spark, sf_dir), ["median"])
    return found.select("sample_ID", rounded("median"))


SUMMARY = """SELECT "sample_ID", ROUND(avg(value), 6) AS "TP_mean", ROUND(median(value), 6) AS "TP_median",
  ROUND(stddev_samp(value), 6) AS "TP_std" """


@query("quantitative_summary", f"{SUMMARY} FROM {ORDERS} GROUP BY 1")
def _quantitative_summary(spark, sf_dir):
    found = N.quantitative_summary(long_orders(spark, sf_dir), "TP")
    return found.select("sample_ID", *[rounded(f"TP_{s}") for s in ("mean", "median", "std")])


@query("quantitative_min_occurrences", f"""SELECT "sample_ID", CASE WHEN n >= 12 THEN mean END AS "TP_mean",
  CASE WHEN n >= 12 THEN n END AS "TP_count" FROM (
  SELECT "sample_ID", ROUND(avg(value), 6) AS mean, COUNT(*) AS n FROM {ORDERS} GROUP BY 1)""")
def _quantitative_min_occurrences(spark, sf_dir):
    found = N.quantitative_summary(long_orders(spark, sf_dir), "TP", ["mean", "count", "nonsense"], min_occurrences=12)
    return found.select("sample_ID", rounded("TP_mean"), "TP_count")


@query("quantile_bins", f"""WITH s AS (SELECT "sample_ID", median(value) AS m FROM {ORDERS} GROUP BY 1),
  e AS (SELECT quantile_cont(m, 0.2) AS e1, quantile_cont(m, 0.4) AS e2, quantile_cont(m, 0.6) AS e3,
        quantile_cont(m, 0.8) AS e4 FROM s)
  SELECT "sample_ID", ROUND(m, 6) AS "TP_median", CAST(1 + CAST(m > e1 AS INT) + CAST(m > e2 AS INT)
    + CAST(m > e3 AS INT) + CAST(m > e4 AS INT) AS INT) AS "TP_bin" FROM s, e""")
def _quantile_bins(spark, sf_dir):
    found = N.quantitative_summary(long_orders(spark, sf_dir), "TP", ["median"], qcut_bins=5)
    return found.select("sample_ID", rounded("TP_median"), "TP_bin")


MULTI = {
    "click": {"output_name": "CLICK", "stats": ["mean", "count"], "qcut_bins": 4},
    "view": {"stats": ["median", "last"], "min_occurrences": 12},
    "error": {"stats": "std, squared"},
}


@query("quantitative_summary_multi", f"""WITH everyone AS (SELECT DISTINCT "sample_ID" FROM {EVENTS}),
  c AS (SELECT "sample_ID", avg(value) AS mean, COUNT(*) AS n FROM {EVENTS} WHERE phenotype = 'click' GROUP BY 1),
  v AS (SELECT "sample_ID", median(value) AS median, COUNT(*) AS n, arg_max(value, (occurrence_date, value)) AS latest
        FROM {EVENTS} WHERE phenotype = 'view' GROUP BY 1),
  e AS (SELECT "sample_ID", stddev_samp(value) AS sd, pow(avg(value), 2) AS sq
        FROM {EVENTS} WHERE phenotype = 'error' GROUP BY 1),
  q AS (SELECT quantile_cont(mean, 0.25) AS q1, quantile_cont(mean, 0.5) AS q2, quantile_cont(mean, 0.75) AS q3 FROM c)
  SELECT "sample_ID", ROUND(mean, 9) AS "CLICK_mean", CAST(c.n AS DOUBLE) AS "CLICK_count",
    CAST(1 + CAST(mean > q1 AS INT) + CAST(mean > q2 AS INT) + CAST(mean > q3 AS INT) AS INT) AS "CLICK_bin",
    CASE WHEN v.n >= 12 THEN ROUND(median, 9) END AS view_median, CASE WHEN v.n >= 12 THEN latest END AS view_last,
    ROUND(sd, 9) AS error_std, ROUND(sq, 6) AS error_squared
  FROM everyone LEFT JOIN c USING ("sample_ID") LEFT JOIN v USING ("sample_ID") LEFT JOIN e USING ("sample_ID"), q""")
def _quantitative_summary_multi(spark, sf_dir):
    found = N.quantitative_summary_multi(long_events(spark, sf_dir), MULTI)
    return found.select(
        "sample_ID", rounded("CLICK_mean", 9), F.col("CLICK_count").cast("double").alias("CLICK_count"), "CLICK_bin",
        rounded("view_median", 9), "view_last", rounded("error_std", 9), rounded("error_squared"))
