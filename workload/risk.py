"""Risk classes."""

from pyspark.sql import functions as F

from cohortweave.operators.quant import sample_stats
from cohortweave.operators.risk import RiskRule, risk_matrix, risk_report
from workload.base import ORDERS, long_orders, query, rounded

RULES = {
    "risk_percentile_binary": RiskRule("percentile", "TP_mean", "TP_risk", high=90, low=5),
    "risk_percentile_multilevel": RiskRule("percentile", "TP_mean", "TP_risk", cutoffs=(20, 50, 95),
                                           labels=("low", "mid", "high", "top")),
    "risk_threshold_binary": RiskRule("threshold", "TP_mean", "TP_risk", high=300000),
    "risk_threshold_multilevel": RiskRule("threshold", "TP_mean", "TP_risk", cutoffs=(150000, 250000)),
    "risk_quantile_bin_binary": RiskRule("quantile_bin", "TP_count", "TP_risk", "count", n=10, high=2, low=1),
    "risk_quantile_bin_multilevel": RiskRule("quantile_bin", "TP_mean", "TP_risk", n=4),
}


def wide(spark, sf_dir):
    """One row per customer; the mean is missing below six orders, TP_none always."""
    stats = sample_stats(long_orders(spark, sf_dir), ["mean", "count", "min"])
    return stats.select(
        "sample_ID", F.when(F.col("n") >= 6, F.col("mean")).alias("TP_mean"), F.col("count").alias("TP_count"),
        F.when(F.col("min") < 0, F.col("min")).alias("TP_none"))


WIDE = f"""(SELECT "sample_ID", CASE WHEN COUNT(*) >= 6 THEN avg(value) END AS m, COUNT(*) AS c FROM {ORDERS} GROUP BY 1)"""


def _cut(p):
    return f"(SELECT quantile_cont(m, {p}) FROM {WIDE})"


# Distinct decile edges of the counts, then the number of inner edges below each count.
BINS = f"""(WITH w AS (SELECT * FROM {WIDE}), raw AS (
    SELECT unnest(quantile_cont(c, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS e FROM w),
  edges AS (SELECT DISTINCT e FROM raw),
  ends AS (SELECT MIN(e) AS lo, MAX(e) AS hi, COUNT(*) - 1 AS bins FROM edges)
  SELECT "sample_ID", bins, (SELECT COUNT(*) FROM edges WHERE e > lo AND e < hi AND e < c) AS bin FROM w, ends)"""

CLASS_SQL = {
    "risk_percentile_binary": f"""CASE WHEN m > {_cut(0.9)} OR m < {_cut(0.05)} THEN 1.0 WHEN m IS NOT NULL THEN 0.0 END""",
    "risk_percentile_multilevel": f"""CASE WHEN m <= {_cut(0.2)} THEN 'low' WHEN m <= {_cut(0.5)} THEN 'mid'
      WHEN m <= {_cut(0.95)} THEN 'high' WHEN m IS NOT NULL THEN 'top' END""",
    "risk_threshold_binary": "CASE WHEN m > 300000 THEN 1.0 WHEN m IS NOT NULL THEN 0.0 END",
    "risk_threshold_multilevel": "CASE WHEN m <= 150000 THEN 0 WHEN m <= 250000 THEN 1 WHEN m IS NOT NULL THEN 2 END",
    "risk_quantile_bin_multilevel": f"""CASE WHEN m <= {_cut(0.25)} THEN 0 WHEN m <= {_cut(0.5)} THEN 1
      WHEN m <= {_cut(0.75)} THEN 2 WHEN m IS NOT NULL THEN 3 END""",
}
KIND = {"risk_percentile_multilevel": "VARCHAR", "risk_threshold_multilevel": "INT", "risk_quantile_bin_multilevel": "INT"}


def _class_sql(name):
    if name == "risk_quantile_bin_binary":
        return f"""SELECT "sample_ID", CAST(CASE WHEN bin >= bins - 2 OR bin < 1 THEN 1 ELSE 0 END AS DOUBLE) AS "TP_risk"
          FROM {BINS}"""
    return f"""SELECT "sample_ID", CAST({CLASS_SQL[name]} AS {KIND.get(name, 'DOUBLE')}) AS "TP_risk" FROM {WIDE}"""


def _register(name):
    @query(name, _class_sql(name))
    def run(spark, sf_dir):
        return risk_matrix(wide(spark, sf_dir), [RULES[name]])


for _name in RULES:
    _register(_name)

MATRIX = [
    RiskRule("percentile", "TP_mean", "high_risk", high=90),
    RiskRule("threshold", "TP_mean", "level_risk", cutoffs=(150000, 250000)),
    RiskRule("quantile_bin", "TP_mean", "quartile", n=4, labels=("q1", "q2", "q3", "q4")),
    RiskRule("percentile", "TP_none", "none_risk", high=90),
    RiskRule("percentile", "no_such_column", "skipped", high=90),
]
HIGH = f"CASE WHEN m > {_cut(0.9)} THEN 1.0 WHEN m IS NOT NULL THEN 0.0 END"
QUARTILE = f"'q' || CAST(1 + {CLASS_SQL['risk_quantile_bin_multilevel']} AS VARCHAR)"
MATRIX_SQL = f"""SELECT "sample_ID", CAST({HIGH} AS DOUBLE) AS high_risk,
  CAST({CLASS_SQL["risk_threshold_multilevel"]} AS INT) AS level_risk, {QUARTILE} AS quartile,
  CAST(NULL AS DOUBLE) AS none_risk FROM {WIDE}"""


@query("risk_matrix", MATRIX_SQL)
def _risk_matrix(spark, sf_dir):
    return risk_matrix(wide(spark, sf_dir), MATRIX)


def _counts(column, label, output, method):
    return f"""SELECT '{output}' AS output_col, '{method}' AS method, 'mean' AS stat,
      CASE WHEN {column} IS NULL THEN 'n_na' ELSE 'class' END AS entry,
      COALESCE({label}, '') AS label, CAST(COUNT(*) AS DOUBLE) AS value FROM m GROUP BY 1, 2, 3, 4, 5"""


@query("risk_report", f"""WITH m AS ({MATRIX_SQL}) {" UNION ALL ".join([
    _counts("high_risk", "CASE high_risk WHEN 1 THEN '1.0' WHEN 0 THEN '0.0' END", "high_risk", "percentile"),
    _counts("level_risk", "CAST(level_risk AS VARCHAR)", "level_risk", "threshold"),
    _counts("quartile", "quartile", "quartile", "quantile_bin"),
    _counts("none_risk", "CAST(none_risk AS VARCHAR)", "none_risk", "percentile")])}
  UNION ALL SELECT 'high_risk', 'percentile', 'mean', 'high_cutoff', '', ROUND({_cut(0.9)}, 4)
  UNION ALL SELECT 'level_risk', 'threshold', 'mean', 'cutoff', unnest(['150000', '250000']), unnest([150000.0, 250000.0])
  UNION ALL SELECT 'quartile', 'quantile_bin', 'mean', 'n_bins', '', 4.0
  UNION ALL SELECT 'quartile', 'quantile_bin', 'mean', 'bin_edge', unnest(['0', '1', '2', '3', '4']),
    unnest([ROUND((SELECT MIN(m) FROM {WIDE}), 4), ROUND({_cut(0.25)}, 4), ROUND({_cut(0.5)}, 4),
            ROUND({_cut(0.75)}, 4), ROUND((SELECT MAX(m) FROM {WIDE}), 4)])""")
def _risk_report(spark, sf_dir):
    return risk_report(wide(spark, sf_dir), MATRIX).withColumn("value", rounded("value", 4))
