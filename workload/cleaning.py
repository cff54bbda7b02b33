"""Outliers and scaling."""

from pyspark.sql import functions as F

from cohortweave.operators.clean import (
    OutlierRule, outlier_filter, outlier_report, scale_filter, scale_report)
from cohortweave.operators.reported import clean_with_reports
from workload.base import EVENTS, day_text, long_events, query, rounded

KEYS = '"sample_ID", phenotype, CAST(occurrence_date AS VARCHAR) AS occurrence_date'

IQR = f"""SELECT phenotype, q1 - m * (q3 - q1) AS lo, q3 + m * (q3 - q1) AS hi FROM (
  SELECT phenotype, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, 1.5 AS m
  FROM {EVENTS} GROUP BY phenotype)"""
ZSCORE = f"""SELECT phenotype, avg(value) - 2 * stddev_samp(value) AS lo, avg(value) + 2 * stddev_samp(value) AS hi
  FROM {EVENTS} GROUP BY phenotype"""


def _cap(fences):
    return f"""SELECT {KEYS}, ROUND(LEAST(GREATEST(value, lo), hi), 9) AS value
      FROM {EVENTS} e JOIN ({fences}) f USING (phenotype)"""


def _remove(fences):
    return f"""SELECT {KEYS}, CASE WHEN value BETWEEN lo AND hi THEN ROUND(value, 9) END AS value
      FROM {EVENTS} e JOIN ({fences}) f USING (phenotype)"""


def _shown(df):
    return df.select("sample_ID", "phenotype", day_text("occurrence_date"), rounded("value", 9))


@query("outlier_iqr_cap", _cap(IQR))
def _iqr_cap(spark, sf_dir):
    return _shown(outlier_filter(long_events(spark, sf_dir), OutlierRule("iqr", "cap")))


@query("outlier_iqr_remove", _remove(IQR))
def _iqr_remove(spark, sf_dir):
    return _shown(outlier_filter(long_events(spark, sf_dir), OutlierRule("iqr", "remove")))


@query("outlier_zscore_cap", _cap(ZSCORE))
def _zscore_cap(spark, sf_dir):
    return _shown(outlier_filter(long_events(spark, sf_dir), OutlierRule("zscore", "cap", zscore_sd=2)))


@query("outlier_zscore_remove", _remove(ZSCORE))
def _zscore_remove(spark, sf_dir):
    return _shown(outlier_filter(long_events(spark, sf_dir), OutlierRule("zscore", "remove", zscore_sd=2)))


# One type is categorical and two are not asked for: they stay as they are.
@query("outlier_filter", f"""SELECT {KEYS}, data_type, ROUND(CASE WHEN phenotype IN ('click', 'view')
  THEN LEAST(GREATEST(value, lo), hi) ELSE value END, 9) AS value FROM (
    SELECT "sample_ID", phenotype, occurrence_date, value,
      CASE WHEN phenotype = 'signup' THEN 'categorical' ELSE data_type END AS data_type FROM {EVENTS}) e
  JOIN ({IQR}) f USING (phenotype)""")
def _outlier_filter(spark, sf_dir):
    mixed = long_events(spark, sf_dir).withColumn(
        "data_type", F.when(F.col("phenotype") == "signup", "categorical").otherwise(F.col("data_type")))
    kept = outlier_filter(mixed, OutlierRule(), ["click", "view", "signup"])
    return kept.select("sample_ID", "phenotype", day_text("occurrence_date"), "data_type", rounded("value", 9))


@query("outlier_report", f"""SELECT phenotype, COUNT(*) AS n_total,
  COUNT(CASE WHEN value < lo OR value > hi THEN 1 END) AS n_capped, CAST(0 AS BIGINT) AS n_removed
  FROM {EVENTS} JOIN ({IQR}) USING (phenotype) GROUP BY phenotype""")
def _outlier_report(spark, sf_dir):
    return outlier_report(long_events(spark, sf_dir), OutlierRule())


STATS = f"""SELECT phenotype, avg(value) AS mean, stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi
  FROM {EVENTS} GROUP BY phenotype"""


@query("scale_zscore", f"""SELECT {KEYS}, ROUND((value - mean) / sd, 9) AS value
  FROM {EVENTS} JOIN ({STATS}) USING (phenotype)""")
def _scale_zscore(spark, sf_dir):
    return _shown(scale_filter(long_events(spark, sf_dir), "zscore"))


@query("scale_minmax", f"""SELECT {KEYS}, ROUND((value - lo) / (hi - lo), 9) AS value
  FROM {EVENTS} JOIN ({STATS}) USING (phenotype)""")
def _scale_minmax(spark, sf_dir):
    return _shown(scale_filter(long_events(spark, sf_dir), "minmax"))


# Scaling after capping: the second statistics are those of the capped values.
@query("scale_filter", f"""WITH capped AS (SELECT "sample_ID", phenotype, occurrence_date,
    LEAST(GREATEST(value, lo), hi) AS value FROM {EVENTS} JOIN ({IQR}) USING (phenotype)),
  stats AS (SELECT phenotype, avg(value) AS mean, stddev_samp(value) AS sd FROM capped GROUP BY phenotype)
  SELECT {KEYS}, ROUND((value - mean) / sd, 9) AS value FROM capped JOIN stats USING (phenotype)""")
def _scale_filter(spark, sf_dir):
    return _shown(scale_filter(outlier_filter(long_events(spark, sf_dir), OutlierRule()), "zscore"))


@query("scale_report", f"""SELECT phenotype, 'minmax' AS method, lo, hi FROM ({STATS})""")
def _scale_report(spark, sf_dir):
    return scale_report(long_events(spark, sf_dir), "minmax")


@query("clean_with_reports", f"""WITH capped AS (SELECT "sample_ID", phenotype, occurrence_date, value AS was,
    LEAST(GREATEST(value, lo), hi) AS value FROM {EVENTS} JOIN ({IQR}) USING (phenotype)),
  s AS (SELECT phenotype, avg(value) AS mean, stddev_samp(value) AS sd, COUNT(*) AS n_total,
    COUNT(CASE WHEN was <> value THEN 1 END) AS n_capped FROM capped GROUP BY phenotype)
  SELECT {KEYS}, ROUND((value - mean) / sd, 9) AS value, n_total, n_capped, CAST(0 AS BIGINT) AS n_removed, ROUND(mean, 6) AS mean
  FROM capped JOIN s USING (phenotype)""")
def _clean_with_reports(spark, sf_dir):
    """Capped and scaled rows beside what both reports say of their phenotype."""
    done = clean_with_reports(long_events(spark, sf_dir), OutlierRule(), "zscore")
    scales = done.scales.select("phenotype", rounded("mean"))
    return _shown(done.rows).join(done.outliers, "phenotype").join(scales, "phenotype")
