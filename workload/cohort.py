"""The whole cohort job, and the flagship query."""

from pyspark.sql import functions as F

from cohortweave.operators.clean import outlier_filter
from cohortweave.operators.coded import CodedDefinition, CodeSource
from cohortweave.operators.mask import EventDefinition
from cohortweave.operators.quant import quantile_bins, quantitative_summary
from cohortweave.operators.risk import RiskRule, risk_matrix
from cohortweave.plans.cohort import run_cohort
from cohortweave.runtime import settle
from workload.base import (
    CODES, EVENTS, ORDERS, PRIORITY, cat_priority, code_records, long_codes, long_events, long_orders, query, rounded, table)

SPECS = [
    {"phenotype_name": "TP", "data_type": "quantitative", "table": "orders", "sample_id_col": "o_custkey",
     "value_col": "o_totalprice", "date_col": "o_orderdate", "stats": ["mean", "count"], "qcut_bins": 4,
     "event_mask": ["early"], "risk_classification": {"method": "percentile", "high": 90}},
    {"phenotype_name": "BIG", "data_type": "quantitative", "table": "orders", "sample_id_col": "o_custkey",
     "value_col": "o_totalprice", "date_col": "o_orderdate", "filter": {"o_orderstatus": ["F", "P*"]},
     "outlier_method": "none", "stats": ["max"]},
    {"phenotype_name": "CLICK", "data_type": "quantitative", "table": "events", "sample_id_col": "user_id",
     "value_col": "value", "filter": {"event_type": ["click"]}, "reference_date": "2024-02-01",
     "scale": True, "stats": ["mean"], "event_mask": ["early"]},
    {"phenotype_name": "PRIORITY", "data_type": "categorical", "table": "orders", "sample_id_col": "o_custkey",
     "value_col": "o_orderpriority", "date_col": "o_orderdate", "one_hot": True,
     "categories": ["1-URGENT", "5-LOW"], "event_mask": ["early"]},
    {"phenotype_name": "DX", "data_type": "coded", "table": "codes", "sample_id_col": "patient", "value_col": "code",
     "date_col": "day", "filter": {"vocabulary": ["DX_F"]}, "subsample": ["A01.*", "A02.3", "N10.*"]},
]
EVENT_LIST = [EventDefinition("early", "DX", ("A01", "A02.3"), -200, 100)]
DEFINITIONS = [CodedDefinition("CASE", (CodeSource("DX", ("N10",), ("A01.1",)),))]
CODE_LIST = {"DX": ["N10.1", "A02.3"]}

SQL = f"""WITH dx AS (SELECT * FROM {CODES} WHERE source = 'DX_F'
    AND (starts_with(value, 'A01.') OR value = 'A02.3' OR starts_with(value, 'N10.'))),
  w AS (SELECT "sample_ID" AS s, occurrence_date - 200 AS ws, occurrence_date + 100 AS we FROM dx
    WHERE starts_with(value, 'A')),
  fences AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM {ORDERS}),
  capped AS (SELECT "sample_ID", occurrence_date,
    LEAST(GREATEST(value, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) AS value FROM {ORDERS}, fences),
  tp AS (SELECT "sample_ID", avg(value) AS mean, COUNT(*) AS n FROM capped x WHERE NOT EXISTS (
    SELECT 1 FROM w WHERE s = "sample_ID" AND occurrence_date BETWEEN ws AND we) GROUP BY 1),
  tq AS (SELECT quantile_cont(mean, 0.25) AS e1, quantile_cont(mean, 0.5) AS e2, quantile_cont(mean, 0.75) AS e3,
    quantile_cont(mean, 0.9) AS p90 FROM tp),
  big AS (SELECT CAST(o_custkey AS VARCHAR) AS "sample_ID", MAX(o_totalprice) AS top FROM orders
    WHERE o_orderstatus = 'F' OR starts_with(o_orderstatus, 'P') GROUP BY 1),
  ck AS (SELECT "sample_ID", value FROM {EVENTS} WHERE phenotype = 'click'),
  cf AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ck),
  cc AS (SELECT "sample_ID", LEAST(GREATEST(value, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) AS value FROM ck, cf),
  cs AS (SELECT avg(value) AS mu, stddev_samp(value) AS sd FROM cc),
  click AS (SELECT "sample_ID", avg((value - mu) / sd) AS mean FROM cc, cs GROUP BY 1),
  pr AS (SELECT "sample_ID", MAX(CAST(value = '1-URGENT' AS INT)) AS urgent, MAX(CAST(value = '5-LOW' AS INT)) AS low
    FROM {PRIORITY} x WHERE NOT EXISTS (
    SELECT 1 FROM w WHERE s = "sample_ID" AND occurrence_date BETWEEN ws AND we) GROUP BY 1),
  code AS (SELECT "sample_ID", MAX(CASE WHEN value = 'N10.1' THEN 1 END) AS n101, MAX(CASE WHEN value = 'A02.3' THEN 1 END)
    AS a023 FROM dx WHERE value IN ('N10.1', 'A02.3') GROUP BY 1),
  verdict AS (SELECT "sample_ID", CAST(CASE WHEN bool_or(starts_with(value, 'N10.')) THEN
    CASE WHEN bool_or(value = 'A01.1') THEN 0 ELSE 1 END END AS INT) AS v FROM dx GROUP BY 1)
  SELECT "sample_ID", ROUND(tp.mean, 6) AS "TP_mean", CAST(tp.n AS BIGINT) AS "TP_count",
    CAST(CASE WHEN tp.mean IS NOT NULL THEN 1 + CAST(tp.mean > e1 AS INT) + CAST(tp.mean > e2 AS INT)
      + CAST(tp.mean > e3 AS INT) END AS INT) AS "TP_bin",
    top AS "BIG_max", ROUND(click.mean, 6) AS "CLICK_mean", urgent AS "PRIORITY_1-URGENT", low AS "PRIORITY_5-LOW",
    n101 AS "N10.1", a023 AS "A02.3", v AS "CASE",
    CAST(CASE WHEN tp.mean > p90 THEN 1 WHEN tp.mean IS NOT NULL THEN 0 END AS DOUBLE) AS "TP_risk"
  FROM tp FULL JOIN big USING ("sample_ID") FULL JOIN click USING ("sample_ID") FULL JOIN pr USING ("sample_ID")
    FULL JOIN code USING ("sample_ID") FULL JOIN verdict USING ("sample_ID"), tq"""


@query("run_cohort", SQL)
def _run_cohort(spark, sf_dir):
    tables = {"orders": table(spark, sf_dir, "orders"), "events": table(spark, sf_dir, "events"),
              "codes": code_records(spark, sf_dir)}
    done = run_cohort(SPECS, tables, events=EVENT_LIST, definitions=DEFINITIONS, codes=CODE_LIST)
    return done.wide.join(done.risk, "sample_ID").withColumns(
        {"TP_mean": rounded("TP_mean"), "CLICK_mean": rounded("CLICK_mean")})


READY = [
    {"phenotype_name": "TOTALPRICE", "data_type": "quantitative", "long_table": "measures", "stats": ["count", "min"], "min_occurrences": 2,
     "event_mask": ["early"]},
    {"phenotype_name": "PRIORITY", "data_type": "categorical", "long_table": "answers", "one_hot": True,
     "categories": ["1-URGENT", "5-LOW"], "event_mask": ["early"]},
    {"phenotype_name": "DX_F", "data_type": "coded", "long_table": "codes", "min_occurrences": 2, "event_mask": ["early"]},
]
READY_CODES = ["N10.1", "A02.3", "R24.4"]
READY_EVENTS = [EventDefinition("early", "DX_F", ("A01", "A02.3"), -200, 100)]
READY_CASE = [CodedDefinition("CASE", (CodeSource("DX_F", ("R1",), ("A01.1",), ("A3*",), prefix_matching=False), CodeSource("DX_F", ("R10",))), missing_as_control=True)]


def _outside(rows):
    return f"""(SELECT x.* FROM {rows} x WHERE NOT EXISTS (SELECT 1 FROM w WHERE s = "sample_ID" AND occurrence_date BETWEEN ws AND we))"""


READY_SQL = f"""WITH dx AS (SELECT * FROM {CODES} WHERE source = 'DX_F'),
  w AS (SELECT DISTINCT "sample_ID" AS s, occurrence_date - 200 AS ws, occurrence_date + 100 AS we FROM dx
    WHERE starts_with(value, 'A01') OR starts_with(value, 'A02.3')),
  tp AS (SELECT "sample_ID", COUNT(*) AS n, MIN(value) AS low FROM {_outside(ORDERS)} GROUP BY 1),
  pr AS (SELECT "sample_ID", MAX(CAST(value = '1-URGENT' AS INT)) AS urgent, MAX(CAST(value = '5-LOW' AS INT)) AS least
    FROM {_outside(PRIORITY)} GROUP BY 1),
  code AS (SELECT "sample_ID", {", ".join(f"CASE WHEN COUNT(CASE WHEN value = '{c}' THEN 1 END) >= 2 THEN 1 END AS c{i}" for i, c in enumerate(READY_CODES))}
    FROM {_outside("dx")} WHERE value IN ({", ".join(f"'{c}'" for c in READY_CODES)}) GROUP BY 1),
  verdict AS (SELECT "sample_ID", CASE WHEN bool_or(value = 'R1' OR starts_with(value, 'R10.')) THEN
    CASE WHEN bool_or(value = 'A01.1') THEN 0 ELSE 1 END WHEN bool_or(starts_with(value, 'A3')) THEN NULL ELSE 0 END AS v FROM dx GROUP BY 1)
  SELECT "sample_ID", 'TOTALPRICE_count' AS phenotype, CASE WHEN n >= 2 THEN CAST(n AS DOUBLE) END AS value FROM tp
  UNION ALL SELECT "sample_ID", 'TOTALPRICE_min', CASE WHEN n >= 2 THEN low END FROM tp
  UNION ALL SELECT "sample_ID", 'PRIORITY_1-URGENT', urgent FROM pr UNION ALL SELECT "sample_ID", 'PRIORITY_5-LOW', least FROM pr
  {" ".join(f"""UNION ALL SELECT "sample_ID", '{c}', c{i} FROM code""" for i, c in enumerate(READY_CODES))}
  UNION ALL SELECT "sample_ID", 'CASE', v FROM verdict"""


@query("run_cohort_ready_long", READY_SQL)
def _run_cohort_ready_long(spark, sf_dir):
    """The whole job on ready-made long tables, gathered cell by cell."""
    codes = long_codes(spark, sf_dir).where("source = 'DX_F'").drop("source")
    tables = {"measures": long_orders(spark, sf_dir), "answers": cat_priority(spark, sf_dir), "codes": codes}
    done = run_cohort(READY, tables, events=READY_EVENTS, definitions=READY_CASE, codes={"DX_F": READY_CODES}, gather="long", results_only=True)
    return done.long.withColumn("value", F.col("value").cast("double"))


@query("flagship", f"""WITH f AS (SELECT phenotype, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
    FROM {EVENTS} GROUP BY 1),
  s AS (SELECT "sample_ID", avg(v) AS mean, median(v) AS median, stddev_samp(v) AS std, COUNT(*) AS n FROM (
    SELECT "sample_ID", LEAST(GREATEST(value, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) AS v
    FROM {EVENTS} JOIN f USING (phenotype)) GROUP BY 1),
  e AS (SELECT quantile_cont(mean, 0.25) AS e1, quantile_cont(mean, 0.5) AS e2, quantile_cont(mean, 0.75) AS e3,
    quantile_cont(mean, 0.9) AS p90 FROM s)
  SELECT "sample_ID", ROUND(mean, 9) AS activity_mean, ROUND(median, 9) AS activity_median, ROUND(std, 9) AS activity_std,
    n AS activity_count, CAST(1 + CAST(mean > e1 AS INT) + CAST(mean > e2 AS INT) + CAST(mean > e3 AS INT) AS INT)
    AS activity_bin, CAST(mean > p90 AS DOUBLE) AS activity_risk FROM s, e""")
def flagship(spark, sf_dir):
    """Cap outliers per event type, summarise per user, bin the means and flag the top decile."""
    clean = outlier_filter(long_events(spark, sf_dir))
    summary = settle(quantitative_summary(clean, "activity", ["mean", "median", "std", "count"]))
    binned = quantile_bins(summary, "activity_mean", 4, "activity_bin")
    risk = risk_matrix(summary, [RiskRule("percentile", "activity_mean", "activity_risk", high=90)])
    shown = binned.withColumns({f"activity_{s}": rounded(f"activity_{s}", 9) for s in ("mean", "median", "std")})
    return shown.join(risk, "sample_ID")
