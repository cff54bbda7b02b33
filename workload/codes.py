"""Pattern matching and coded phenotypes."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.vocabulary import detect_column_type, detect_value_type
from cohortweave.operators import coded as E
from cohortweave.operators.codes import code_pattern_match, normalize_patterns, sample_has_any_code
from cohortweave.runtime import quoted, scratch_path
from workload.base import CODES, ROSTER, cat_priority, code_records, long_codes, long_events, query, roster, table

PATTERNS = ["N24.*", "A1*", "R50.7", "A33.", " N10.2 "]
PATTERNS_SQL = """(starts_with(value, 'N24.') OR starts_with(value, 'A1') OR value = 'R50.7'
  OR starts_with(value, 'A33.') OR value = 'N10.2')"""


@query("code_pattern_match", f"""SELECT "sample_ID", value, CAST({PATTERNS_SQL} AS INT) AS matches FROM {CODES}""")
def _code_pattern_match(spark, sf_dir):
    return long_codes(spark, sf_dir).select(
        "sample_ID", "value", code_pattern_match(F.col("value"), PATTERNS).cast("int").alias("matches"))


# 'R*' shares its first two characters with no code and matches none; bare 'N31' stands for 'N31.*'.
@query("sample_has_any_code", f"""SELECT "sample_ID", CAST(bool_or(starts_with(value, 'N31.') OR value = 'A05.1') AS INT)
  AS has_code FROM {CODES} GROUP BY "sample_ID" """)
def _sample_has_any_code(spark, sf_dir):
    found = sample_has_any_code(long_codes(spark, sf_dir), normalize_patterns(["N31", "A05.1", "R*"]))
    return found.withColumn("has_code", F.col("has_code").cast("int"))


@query("detect_value_type", """SELECT * FROM (
  SELECT 'code' AS "column", COUNT(*) AS n_values, 'ICD10' AS value_type FROM lineitem
  UNION ALL SELECT 'o_orderkey', (SELECT COUNT(*) FROM orders), CASE WHEN
    (SELECT avg(CAST(regexp_full_match(CAST(o_orderkey AS VARCHAR), '[0-9]{3,5}') AS INT)) FROM orders) > 0.7
    THEN 'ICD9' ELSE 'quantitative' END
  UNION ALL SELECT 'o_totalprice', (SELECT COUNT(*) FROM orders), CASE WHEN (SELECT avg(CAST(regexp_full_match(
    CAST(o_totalprice AS VARCHAR), '[0-9]{3,5}(\\.[0-9]+)?') AS INT)) FROM orders) > 0.7
    THEN 'ICD9' ELSE 'quantitative' END
  UNION ALL SELECT 'o_orderpriority', (SELECT COUNT(*) FROM orders), 'categorical')""")
def _detect_value_type(spark, sf_dir):
    orders = detect_value_type(table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice", "o_orderpriority"])
    return detect_value_type(code_records(spark, sf_dir), ["code"]).unionByName(orders)


# Codes and event types in the place of column names.
@query("detect_column_type", f"""SELECT DISTINCT value AS name, 'ICD10' AS name_type FROM {CODES}
  UNION ALL SELECT DISTINCT event_type || '_weight', 'quantitative' FROM events
  UNION ALL SELECT DISTINCT o_orderpriority, NULL FROM orders""")
def _detect_column_type(spark, sf_dir):
    names = (
        long_codes(spark, sf_dir).select(F.col("value").alias("name"))
        .unionByName(long_events(spark, sf_dir).select(F.concat("phenotype", F.lit("_weight")).alias("name")))
        .unionByName(cat_priority(spark, sf_dir).select(F.col("value").alias("name"))).distinct())
    return names.withColumn("name_type", detect_column_type(F.col("name")))


COUNTS = f'(SELECT "sample_ID", value, COUNT(*) AS n FROM {CODES} GROUP BY 1, 2)'


@query("basic_coded", f"""SELECT "sample_ID", CASE WHEN n >= 2 THEN 1 WHEN n IS NULL THEN 0 END AS "N24.4"
  FROM {ROSTER} r LEFT JOIN (SELECT "sample_ID", n FROM {COUNTS} WHERE value = 'N24.4') c USING ("sample_ID")""")
def _basic_coded(spark, sf_dir):
    return E.basic_coded(long_codes(spark, sf_dir), "N24.4", roster(spark, sf_dir), 2, missing_as_control=True)


@query("basic_coded_long", f"""SELECT "sample_ID", value AS phenotype, CASE WHEN n >= 2 THEN 1 END AS value FROM {COUNTS}""")
def _basic_coded_long(spark, sf_dir):
    return E.basic_coded_long(long_codes(spark, sf_dir), 2)


CHAPTERS = [f"{flag}.{line}" for flag in "ANR" for line in range(1, 8)]
CHAPTER = "substr(value, 1, 1) || substr(value, 4, 2)"


@query("basic_coded_matrix", 'SELECT "sample_ID", ' + ", ".join(
    f"""CASE WHEN SUM(CASE WHEN {CHAPTER} = '{c}' THEN 1 ELSE 0 END) >= 3 THEN 1
        WHEN COUNT(CASE WHEN {CHAPTER} = '{c}' THEN 1 END) = 0 THEN 0 END AS "{c}" """ for c in CHAPTERS)
    + f""" FROM {ROSTER} r LEFT JOIN {CODES} c USING ("sample_ID") GROUP BY "sample_ID" """)
def _basic_coded_matrix(spark, sf_dir):
    chapter = F.concat(F.substring("value", 1, 1), F.substring("value", 4, 2))
    rows = long_codes(spark, sf_dir).withColumn("phenotype", chapter)
    return E.basic_coded_matrix(rows, CHAPTERS, roster(spark, sf_dir), 3, missing_as_control=True)


@query("basic_coded_blocks", f"""SELECT "sample_ID", value AS phenotype, CAST(1 AS INT) AS value FROM {COUNTS} WHERE n >= 2""")
def _basic_coded_blocks(spark, sf_dir):
    """All codes, written in blocks of 300 and read back block by block as columns; the cells that are filled."""
    path = scratch_path(spark, "blocks")
    E.write_code_blocks(long_codes(spark, sf_dir), path, 300, 2)
    blocks = sorted(r[0] for r in spark.read.parquet(f"{path}/catalogue").select("block").distinct().collect())
    return reduce(DataFrame.union, [_filled(E.read_code_block(spark, path, b)) for b in blocks])  # 300 columns each


def _filled(wide: DataFrame) -> DataFrame:
    """(sample_ID, phenotype, value) of the cells of a wide table that are not null; the others never become rows."""
    names = [c for c in wide.columns if c != "sample_ID"]
    cells = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col(quoted(c)) for c in names]))
    return wide.select("sample_ID", F.explode(F.map_filter(cells, lambda code, value: value.isNotNull())).alias("phenotype", "value"))


@query("per_code_min_occurrences", f'SELECT "sample_ID", value, n FROM {COUNTS} WHERE n >= 2')
def _per_code_min_occurrences(spark, sf_dir):
    return E.per_code_min_occurrences(long_codes(spark, sf_dir), 2)


def _test(patterns):
    """SQL test for already normalized patterns."""
    tests = [f"starts_with(value, '{p.rstrip('*')}')" if p.endswith(("*", ".")) else f"value = '{p}'" for p in patterns]
    return "(" + " OR ".join(tests) + ")" if tests else "FALSE"


def verdict_sql(case, case_exclude=(), control_exclude=(), sources=("DX_F", "DX_O"), least=1, control="NULL"):
    """SQL for one definition: (sample_ID, value, decided)."""
    listed = ", ".join(f"'{s}'" for s in sources)
    return f"""SELECT "sample_ID", CAST(CASE WHEN bool_or({_test(case)} AND n >= {least}) THEN
        CASE WHEN bool_or({_test(case_exclude)} AND n >= {least}) THEN 0 ELSE 1 END
      WHEN bool_or({_test(control_exclude)} AND n >= {least}) THEN NULL ELSE {control} END AS INT) AS value,
      bool_or(({_test(case)} OR {_test(control_exclude)}) AND n >= {least}) OR {control} IS NOT NULL AS decided
      FROM (SELECT "sample_ID", value, COUNT(*) AS n FROM {CODES} WHERE source IN ({listed}) GROUP BY 1, 2)
      GROUP BY "sample_ID" """


SINGLE = E.CodedDefinition("N2X", (E.CodeSource("DX_F", ("N21", "N22", "N24.4"), ("A1*",), ("R2*", "R30")),),
                           missing_as_control=True)


@query("advanced_coded", f"""SELECT "sample_ID", value AS "N2X" FROM ({verdict_sql(
    ["N21.*", "N22.*", "N24.4"], ["A1*"], ["R2*", "R30.*"], ["DX_F"], control="0")})""")
def _advanced_coded(spark, sf_dir):
    return E.advanced_coded(long_codes(spark, sf_dir), SINGLE)


POOLED = E.CodedDefinition("MIXED", (
    E.CodeSource("DX_F", ("N10", "N11.1"), ("A20",), ("R1*", "R05")),
    E.CodeSource("DX_O", ("A4.*", "A45"), (), ("A05",), prefix_matching=False)), output_name="mixed",
    min_occurrences=1, missing_as_control=True)


@query("advanced_coded_multi_source", f"""SELECT "sample_ID", value AS mixed FROM ({verdict_sql(
    ["N10.*", "N11.1", "A4.*", "A45"], ["A20.*"], ["R1*", "R05.*", "A05"], control="0")})""")
def _advanced_coded_multi_source(spark, sf_dir):
    return E.advanced_coded(long_codes(spark, sf_dir), POOLED)


def library() -> list[E.CodedDefinition]:
    """Forty definitions over both sources, every fourth asking for two occurrences."""
    out = []
    for i in range(1, 41):
        case, case_out, control_out = f"{'ANR'[i % 3]}{i:02d}", f"{'NRA'[i % 3]}{i + 5:02d}.1", f"{'RAN'[i % 3]}{i + 9:02d}"
        sources = [E.CodeSource("DX_F", (case,), (case_out,), (control_out,))]
        if i % 2:
            sources.append(E.CodeSource("DX_O", (f"{case}.*",)))
        out.append(E.CodedDefinition(f"D{i:02d}", tuple(sources), min_occurrences=2 if i % 4 == 0 else 1,
                                     missing_as_control=bool(i % 3)))
    return out


def _library_sql():
    parts = []
    for i in range(1, 41):
        case, case_out, control_out = f"{'ANR'[i % 3]}{i:02d}", f"{'NRA'[i % 3]}{i + 5:02d}.1", f"{'RAN'[i % 3]}{i + 9:02d}"
        verdict = verdict_sql([f"{case}.*"], [case_out], [f"{control_out}.*"], ["DX_F", "DX_O"] if i % 2 else ["DX_F"],
                              2 if i % 4 == 0 else 1, "0" if i % 3 else "NULL")
        parts.append(f"SELECT 'D{i:02d}' AS phenotype, \"sample_ID\", value, decided FROM ({verdict})")
    return " UNION ALL ".join(parts)


@query("advanced_coded_batch", f'SELECT phenotype, "sample_ID", value FROM ({_library_sql()})')
def _advanced_coded_batch(spark, sf_dir):
    """Every pair of a definition and a sample with rows in one of its sources, decided or not."""
    return E.advanced_coded_batch(long_codes(spark, sf_dir), library(), undecided=True)


@query("advanced_coded_matrix", 'SELECT "sample_ID", ' + ", ".join(
    f"MAX(CASE WHEN phenotype = 'D{i:02d}' THEN value END) AS \"D{i:02d}\"" for i in range(1, 41))
    + f' FROM ({_library_sql()}) GROUP BY "sample_ID"')
def _advanced_coded_matrix(spark, sf_dir):
    return E.advanced_coded_matrix(long_codes(spark, sf_dir), library())
