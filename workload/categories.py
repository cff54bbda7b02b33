"""Categorical encodings."""

from pyspark.sql import functions as F

from cohortweave.operators.categorical import CategoricalSpec, categorical, categorical_matrix_multi
from workload.base import PRIORITY, ROSTER, SEGMENT, cat_priority, cat_segment, query, roster

DICTIONARY = {"1-URGENT": 3, "2-HIGH": 2, "3-MEDIUM": 1, "4-NOT SPECIFIED": "NA", "5-LOW": 0}
PRIORITIES = sorted(DICTIONARY)


@query("categorical_binary", f"""SELECT "sample_ID", CASE WHEN COUNT(p.value) > 0 THEN 1 ELSE 0 END AS "HAS_ORDER"
  FROM {ROSTER} LEFT JOIN {PRIORITY} p USING ("sample_ID") GROUP BY 1""")
def _binary(spark, sf_dir):
    spec = CategoricalSpec("PRIORITY", "HAS_ORDER", missing_as_control=True)
    return categorical(cat_priority(spark, sf_dir), spec, roster(spark, sf_dir))


MODE = f"""(SELECT "sample_ID", code FROM (SELECT "sample_ID", code, ROW_NUMBER() OVER (
    PARTITION BY "sample_ID" ORDER BY COUNT(*) DESC, code) AS place FROM (
    SELECT "sample_ID", CASE value WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1
      WHEN '5-LOW' THEN 0 END AS code FROM {PRIORITY}) WHERE code IS NOT NULL GROUP BY 1, 2) WHERE place = 1)"""


@query("categorical_dictionary", f"""SELECT r."sample_ID", CASE WHEN n IS NULL THEN 0 ELSE code END AS "URGENCY"
  FROM {ROSTER} r LEFT JOIN (SELECT "sample_ID", COUNT(*) AS n FROM {PRIORITY} GROUP BY 1) USING ("sample_ID")
  LEFT JOIN {MODE} USING ("sample_ID")""")
def _dictionary(spark, sf_dir):
    spec = CategoricalSpec("PRIORITY", "URGENCY", dictionary=DICTIONARY, missing_as_control=True)
    return categorical(cat_priority(spark, sf_dir), spec, roster(spark, sf_dir))


@query("categorical_one_hot", 'SELECT "sample_ID", ' + ", ".join(
    f"""MAX(CASE WHEN value = '{p}' THEN 1 WHEN value IS NOT NULL THEN 0 END) AS "PRIORITY_{p}" """ for p in PRIORITIES)
    + f' FROM {ROSTER} LEFT JOIN {PRIORITY} USING ("sample_ID") GROUP BY 1')
def _one_hot(spark, sf_dir):
    # The categories are found in the data.
    spec = CategoricalSpec("PRIORITY", one_hot=True)
    return categorical(cat_priority(spark, sf_dir), spec, roster(spark, sf_dir))


@query("categorical_min_occurrences", f"""SELECT "sample_ID", CASE WHEN n >= 12 THEN code END AS "URGENCY"
  FROM (SELECT "sample_ID", COUNT(*) AS n FROM {PRIORITY} GROUP BY 1) LEFT JOIN {MODE} USING ("sample_ID")""")
def _min_occurrences(spark, sf_dir):
    spec = CategoricalSpec("PRIORITY", "URGENCY", dictionary=DICTIONARY, min_occurrences=12, missing_as_control=True)
    return categorical(cat_priority(spark, sf_dir), spec)


@query("categorical_matrix_multi", f"""SELECT "sample_ID", CASE WHEN n >= 12 THEN 1 ELSE 0 END AS "MANY",
  "SEGMENT_BUILDING", "SEGMENT_MACHINERY"
  FROM (SELECT "sample_ID", COUNT(p.value) AS n FROM {ROSTER} LEFT JOIN {PRIORITY} p USING ("sample_ID") GROUP BY 1)
  LEFT JOIN (SELECT "sample_ID", MAX(CAST(value = 'BUILDING' AS INT)) AS "SEGMENT_BUILDING",
    MAX(CAST(value = 'MACHINERY' AS INT)) AS "SEGMENT_MACHINERY" FROM {SEGMENT} GROUP BY 1) USING ("sample_ID")""")
def _matrix_multi(spark, sf_dir):
    rows = cat_priority(spark, sf_dir).unionByName(cat_segment(spark, sf_dir).withColumn(
        "occurrence_date", F.col("occurrence_date").cast("date")))
    return categorical_matrix_multi(rows, [
        CategoricalSpec("PRIORITY", "MANY", min_occurrences=12, missing_as_control=True),
        CategoricalSpec("SEGMENT", one_hot=True, categories=["BUILDING", "MACHINERY"])])
