"""Event windows and masking."""

from pyspark.sql import functions as F

from cohortweave.operators import mask as M
from cohortweave.runtime import settle
from workload.base import CODES, ORDERS, day_text, long_codes, long_events, long_orders, query, table

EVENT_LIST = (
    M.EventDefinition("early", "DX_F", ("A01", "A02.3"), -20, 10),
    M.EventDefinition("late", "DX_O", ("R4", "R50", "N07.1"), -3, 30),
    M.EventDefinition("same_day", "DX_F", ("N",)),  # one character: matches no longer code
    M.EventDefinition("wide", "DX_F", ("N2",), -40, 5),
)

MARKED = f"""(SELECT c.*, CASE WHEN source = 'DX_F' AND (starts_with(value, 'A01') OR starts_with(value, 'A02.3'))
    THEN 'early' WHEN source = 'DX_O' AND (starts_with(value, 'R4') OR starts_with(value, 'R50')
      OR starts_with(value, 'N07.1')) THEN 'late'
    WHEN source = 'DX_F' AND starts_with(value, 'N2') THEN 'wide' END AS event_type FROM {CODES} c)"""

WINDOWS = f"""(SELECT "sample_ID", event_type,
  occurrence_date + CASE event_type WHEN 'early' THEN -20 WHEN 'late' THEN -3 ELSE -40 END AS window_start,
  occurrence_date + CASE event_type WHEN 'early' THEN 10 WHEN 'late' THEN 30 ELSE 5 END AS window_end
  FROM {MARKED} WHERE event_type IS NOT NULL)"""


def _merge_sql(source, keys):
    """Gaps and islands over distinct windows."""
    return f"""(SELECT {keys}, MIN(window_start) AS window_start, MAX(window_end) AS window_end FROM (
      SELECT *, SUM(opens) OVER (PARTITION BY {keys} ORDER BY window_start, window_end) AS island FROM (
        SELECT *, CASE WHEN window_start <= MAX(window_end) OVER (PARTITION BY {keys}
          ORDER BY window_start, window_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens
        FROM (SELECT DISTINCT {keys}, window_start, window_end FROM {source}))) GROUP BY {keys}, island)"""


MERGED = _merge_sql(WINDOWS, '"sample_ID", event_type')
DATES = "CAST(window_start AS VARCHAR) AS window_start, CAST(window_end AS VARCHAR) AS window_end"


def _shown(df):
    return df.withColumns({c: day_text(c) for c in ("window_start", "window_end")})


def coded_rows(spark, sf_dir):
    """The coded rows, written once: their distinct codes are asked first and joining the tables twice costs more."""
    return settle(long_codes(spark, sf_dir).select("sample_ID", "value", "source", "occurrence_date"))


def intervals(spark, sf_dir):
    return M.mask_intervals(coded_rows(spark, sf_dir), EVENT_LIST)


@query("event_code_select", f"""SELECT "sample_ID", value, source, event_type FROM {MARKED} WHERE event_type IS NOT NULL""")
def _event_code_select(spark, sf_dir):
    return M.event_code_select(coded_rows(spark, sf_dir), EVENT_LIST).select("sample_ID", "value", "source", "event_type")


@query("event_windows", f"SELECT \"sample_ID\", event_type, {DATES} FROM {WINDOWS}")
def _event_windows(spark, sf_dir):
    return _shown(M.event_windows(M.event_code_select(coded_rows(spark, sf_dir), EVENT_LIST)))


AROUND = """(SELECT CAST(user_id AS VARCHAR) AS "sample_ID", event_type, CAST(ts AS DATE) - 1 AS window_start,
  CAST(ts AS DATE) + 2 AS window_end FROM events)"""


@query("merge_intervals", f"""SELECT "sample_ID", event_type, {DATES} FROM {_merge_sql(AROUND, '"sample_ID", event_type')}""")
def _merge_intervals(spark, sf_dir):
    around = long_events(spark, sf_dir).select(
        "sample_ID", F.col("phenotype").alias("event_type"), F.date_add("occurrence_date", -1).alias("window_start"),
        F.date_add("occurrence_date", 2).alias("window_end"))
    return _shown(M.merge_intervals(around, ["sample_ID", "event_type"]))


@query("mask_intervals", f"SELECT \"sample_ID\", event_type, {DATES} FROM {MERGED}")
def _mask_intervals(spark, sf_dir):
    return _shown(intervals(spark, sf_dir))


@query("mask_event_types", f"""SELECT "sample_ID", {DATES} FROM {_merge_sql(
    f"(SELECT * FROM {WINDOWS} WHERE event_type IN ('early', 'wide'))", '"sample_ID"')}""")
def _mask_event_types(spark, sf_dir):
    return _shown(M.mask_event_types(intervals(spark, sf_dir), ["early", "wide"]))


def _apply_sql(rows, test):
    return f"""SELECT "sample_ID", phenotype, value, CAST(occurrence_date AS VARCHAR) AS occurrence_date FROM {rows} x
      WHERE NOT EXISTS (SELECT 1 FROM {WINDOWS} w WHERE w."sample_ID" = x."sample_ID"
        AND x.occurrence_date BETWEEN window_start AND window_end AND ({test}))"""


@query("apply_mask", _apply_sql(ORDERS, "event_type IN ('early', 'late')"))
def _apply_mask(spark, sf_dir):
    kept = M.apply_mask(long_orders(spark, sf_dir), intervals(spark, sf_dir), ["early", "late"])
    return kept.select("sample_ID", "phenotype", "value", day_text("occurrence_date"))


LAYERED = """(SELECT "sample_ID", CASE WHEN value < 100000 THEN 'LOW' WHEN value < 300000 THEN 'MID' ELSE 'TOP' END
  AS phenotype, value, occurrence_date FROM """ + ORDERS + ")"


@query("apply_mask_batch", _apply_sql(LAYERED, """(x.phenotype = 'LOW' AND event_type = 'wide')
  OR (x.phenotype = 'MID' AND event_type IN ('early', 'late'))"""))
def _apply_mask_batch(spark, sf_dir):
    band = F.when(F.col("value") < 100000, "LOW").when(F.col("value") < 300000, "MID").otherwise("TOP")
    rows = long_orders(spark, sf_dir).withColumn("phenotype", band)
    kept = M.apply_mask_batch(rows, intervals(spark, sf_dir), {"LOW": ["wide"], "MID": ["early", "late"], "TOP": []})
    return kept.select("sample_ID", "phenotype", "value", day_text("occurrence_date"))


@query("event_definitions_from_table", """SELECT DISTINCT replace(lower(p_type), ' ', '_') AS event_type,
  'P' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS code, 'ICD10' AS source, -270 AS offset_before, 90 AS offset_after
  FROM part""")
def _event_definitions(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("TRIMESTER"),
        F.concat(F.lit("P"), F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("ICD10"))
    return M.event_definitions_from_table(parts)
