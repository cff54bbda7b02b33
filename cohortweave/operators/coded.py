"""Coded phenotypes: presence of single codes and named case/control definitions.

Values: 1 case, 0 control, null unknown or excluded.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.functions.values import strip
from cohortweave.operators.chunks import cohort_chunks
from cohortweave.operators.codes import match_codes, normalize_patterns, pattern_keys
from cohortweave.runtime import local_table, quoted, settle

MAX_PIVOT_COLUMNS = 10_000


def code_counts(long: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows per key combination; rows with a null key belong to no group."""
    keys = list(keys)
    for key in keys:
        long = long.where(F.col(key).isNotNull())
    return long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def presence(n, min_occurrences: int, missing_as_control: bool):
    out = F.when(n >= min_occurrences, F.lit(1))
    return out.when(n.isNull(), F.lit(0)) if missing_as_control else out


def basic_coded(long: DataFrame, code: str, roster: DataFrame | None = None, min_occurrences: int = 1,
                missing_as_control: bool = False) -> DataFrame:
    """Presence of one code per sample: (sample_ID, {code}).

    Too few rows give null; samples of the roster without the code give null, or 0 with
    `missing_as_control`. Without a roster only samples that have the code appear.
    """
    counts = code_counts(long.where(F.col("phenotype") == code), ["sample_ID"])
    if roster is not None:
        counts = roster.select("sample_ID").join(counts, "sample_ID", "left")
    value = presence(F.col("n"), min_occurrences, missing_as_control).cast("int")
    return counts.select("sample_ID", value.alias(code))


def basic_coded_long(long: DataFrame, min_occurrences: int = 1) -> DataFrame:
    """Presence of every code at once, one row per (sample, code) in the data.

    This is the form to keep for large vocabularies; its size follows the data, not
    samples x codes.
    """
    counts = code_counts(long, ["sample_ID", "phenotype"])
    return counts.select(
        "sample_ID", "phenotype", presence(F.col("n"), min_occurrences, False).cast("int").alias("value"))


def list_codes(long: DataFrame, limit: int = MAX_PIVOT_COLUMNS) -> list[str]:
    """The distinct phenotypes, for use as columns. More than `limit` cannot be columns."""
    rows = long.where(F.col("phenotype").isNotNull()).select("phenotype").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} codes: keep the long form or name the wanted codes")
    return sorted(r[0] for r in rows)


def basic_coded_matrix(long: DataFrame, codes: Iterable[str] | None = None, roster: DataFrame | None = None,
                       min_occurrences: int = 1, missing_as_control: bool = False) -> DataFrame:
    """Presence of many codes as columns. Naming the codes saves the job that lists them."""
    codes = list_codes(long) if codes is None else list(codes)
    counts = (
        code_counts(long.where(F.col("phenotype").isin(*codes)), ["sample_ID", "phenotype"])
        .groupBy("sample_ID").pivot("phenotype", codes).agg(F.first("n"))
    )
    if roster is not None:
        counts = roster.select("sample_ID").join(counts, "sample_ID", "left")
    return counts.select("sample_ID", *[
        presence(F.col(quoted(c)), min_occurrences, missing_as_control and roster is not None).cast("int").alias(c)
        for c in codes
    ])


def write_code_blocks(long: DataFrame, path: str, block: int = 1000, min_occurrences: int = 1) -> None:
    """Presence of every code of a vocabulary of any size, for reading back `block` codes at a time as columns.

    `path`/catalogue lists the codes in order with the block each belongs to; `path`/cells has one row per sample and block, a map
    from code to value of what the sample has, in a folder per block. Nothing is listed on the driver and no row is as
    wide as the vocabulary.
    """
    counted = long.where(F.col("phenotype").isNotNull()).groupBy("sample_ID", "phenotype").agg(F.count(F.lit(1)).alias("n"))
    counted = settle(counted.withColumn("value", presence(F.col("n"), min_occurrences, False).cast("int")).drop("n"))
    catalogue = settle(cohort_chunks(counted.select("phenotype").distinct(), block, "phenotype").withColumnRenamed("chunk_id", "block"))
    catalogue.write.parquet(f"{path}/catalogue")
    # Dealt by (block, sample) before they are gathered: the cells move once, and what a task gathers it also writes.
    cells = counted.where("sample_ID IS NOT NULL").join(catalogue, "phenotype").repartitionByRange("block", "sample_ID")
    rows = cells.groupBy("block", "sample_ID").agg(F.map_from_entries(F.collect_list(F.struct("phenotype", "value"))).alias("cells"))
    rows.write.partitionBy("block").parquet(f"{path}/cells")


def read_code_block(spark: SparkSession, path: str, block: str, roster: DataFrame | None = None, missing_as_control: bool = False) -> DataFrame:
    """One block of `write_code_blocks` as columns, as `basic_coded_matrix` gives them; only its folder is read."""
    listed = spark.read.parquet(f"{path}/catalogue").where(F.col("block") == block)
    names = sorted(r[0] for r in listed.select("phenotype").collect())  # at most the size of a block
    rows = spark.read.schema("sample_ID string, cells map<string,int>, block string").parquet(f"{path}/cells").where(F.col("block") == block)
    if roster is not None:
        rows = roster.select("sample_ID").join(rows, "sample_ID", "left")
    own = lambda c: F.try_element_at("cells", F.lit(c))
    if missing_as_control and roster is not None:
        has = lambda c: F.coalesce(F.map_contains_key("cells", c), F.lit(False))
        return rows.select("sample_ID", *[F.when(has(c), own(c)).otherwise(0).alias(c) for c in names])
    some = rows.withColumn("cells", F.map_filter("cells", lambda code, value: value.isNotNull()))  # a column searches what is left
    return some.select("sample_ID", *[own(c).alias(c) for c in names])


@dataclass(frozen=True)
class CodeSource:
    """Patterns one definition applies, and the coded phenotype its rows come from."""

    from_phenotype: str
    case_codes: tuple[str, ...]
    case_exclude: tuple[str, ...] = ()
    control_exclude: tuple[str, ...] = ()
    prefix_matching: bool | None = None  # None: as the definition says


@dataclass(frozen=True)
class CodedDefinition:
    name: str
    sources: tuple[CodeSource, ...]
    output_name: str | None = None
    min_occurrences: int = 1
    missing_as_control: bool = False
    prefix_matching: bool = True

    @property
    def column(self) -> str:
        return self.output_name or self.name

    def patterns(self) -> list[tuple[str, str]]:
        """(role, pattern) pooled over the sources: an exclusion of one acts on the others."""
        out = []
        for source in self.sources:
            prefix = self.prefix_matching if source.prefix_matching is None else source.prefix_matching
            for role in ("case_codes", "case_exclude", "control_exclude"):
                out += [(role, p) for p in normalize_patterns(getattr(source, role), prefix)]
        return out


ROLES = {"case_codes": "is_case", "case_exclude": "is_case_excluded", "control_exclude": "is_control_excluded"}


def per_code_min_occurrences(long: DataFrame, min_occurrences: int) -> DataFrame:
    """(sample_ID, value, n) of codes seen often enough in a sample; counts are not pooled over codes."""
    return code_counts(long, ["sample_ID", "value"]).where(F.col("n") >= min_occurrences)


CASE, EXCLUDED_CASE, NOT_A_CONTROL = 1, 0, -1

# Counts per (source, sample, code) that a task pools at a time.
TASK_COUNTS = 250_000


def _checked(definitions: Iterable[CodedDefinition]) -> list[CodedDefinition]:
    definitions = list(definitions)
    names = [d.column for d in definitions]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"more than one definition of {', '.join(twice)}")
    return definitions


def _sources(definition: CodedDefinition) -> list[str]:
    return sorted({s.from_phenotype for s in definition.sources})


def _pattern_table(spark, definitions: list[CodedDefinition]) -> DataFrame:
    """(phenotype, least, one flag per role, pattern_source, key, is_prefix) of all patterns of all definitions."""
    rows = list(dict.fromkeys(
        (d.column, d.min_occurrences, role, source, pattern)
        for d in definitions for role, pattern in d.patterns() for source in _sources(d)))
    columns = dict(zip(("phenotype", "least", "role", "pattern_source", "pattern"), map(list, zip(*rows)) if rows else [[]] * 5))
    kinds = dict.fromkeys(columns, pa.string()) | {"least": pa.int64()}
    flags = [(F.col("role") == role).alias(flag) for role, flag in ROLES.items()]
    return local_table(spark, columns, kinds).select("phenotype", "least", *flags, "pattern_source", F.inline(F.array(pattern_keys(F.col("pattern")))))


def _per_sample(long: DataFrame, definitions: list[CodedDefinition], everyone: bool) -> DataFrame:
    """(sample_ID, verdicts, seen): what the codes of a sample decide, by definition, and the sources it has rows in.

    The rows are read once, for the counts per (source, sample, code), combined on the map side; after that a sample has at most
    as many rows as there are codes, and all its pooling happens behind one exchange by sample. What the distinct codes meet is
    written too, so that its size is known and the counts need not move to meet it. With `everyone` the join keeps counts
    without a pattern as markers, so that undecided samples survive; else only matched counts are shuffled again. The
    sources of a sample are one flag each, so that pooling keeps a state of fixed size and sorts no rows; a task
    pools some TASK_COUNTS counts, however many there are.
    """
    sources = sorted({s for d in definitions for s in _sources(d)})
    rows = long.where(F.col("source").isin(*sources) & F.col("sample_ID").isNotNull())
    counts = rows.groupBy("source", "sample_ID", "value").agg(F.count(F.lit(1)).alias("n"))
    counts = settle(counts.withColumn("code", strip(F.col("value").cast("string"))))
    flags = [F.max(name).alias(name) for name in ROLES.values()]
    met = match_codes(counts.select("source", "code").distinct(), _pattern_table(long.sparkSession, definitions))
    met = settle(met.groupBy("source", "code", "phenotype", "least").agg(*flags))  # a code may play several roles
    matched = counts.join(met, ["source", "code"], "left" if everyone else "inner").drop("code").repartition(1 + counts.count() // TASK_COUNTS, "sample_ID")
    pooled_value = F.when(F.col("phenotype").isNotNull(), F.col("value")).alias("value")
    marks = {f"_seen_{i}": name for i, name in enumerate(sources)} if everyone else {}
    seen = [F.max(mark).alias(mark) for mark in marks]
    pooled = matched.withColumns({mark: F.col("source") == name for mark, name in marks.items()}).groupBy("sample_ID", "phenotype", pooled_value).agg(
        (F.sum("n") >= F.max("least")).alias("enough"), *flags, *seen)
    decided = pooled.groupBy("sample_ID", "phenotype").agg(*[F.max(F.col(f) & F.col("enough")).alias(f) for f in ROLES.values()], *seen)
    verdict = (
        F.when(F.col("is_case"), F.when(F.col("is_case_excluded"), EXCLUDED_CASE).otherwise(CASE))
        .when(F.col("is_control_excluded"), NOT_A_CONTROL)
    )
    found = F.when(F.col("phenotype").isNotNull() & verdict.isNotNull(), F.struct("phenotype", verdict.alias("verdict")))
    of_sample = decided.groupBy("sample_ID").agg(F.map_from_entries(F.collect_list(found)).alias("verdicts"), *seen)
    named = F.array_compact(F.array(*[F.when(F.col(mark), F.lit(name)) for mark, name in marks.items()])).cast("array<string>")
    return of_sample.select("sample_ID", "verdicts", named.alias("seen"))


def _of_roster(samples: DataFrame, roster: DataFrame | None) -> DataFrame:
    """`samples`, or those of the roster: the latter count as seen everywhere."""
    if roster is None:
        return samples
    return roster.select("sample_ID").join(samples.drop("seen"), "sample_ID", "left").withColumn("seen", F.lit(None).cast("array<string>"))


def _seen_in(definition_sources: Column) -> Column:
    return F.col("seen").isNull() | F.arrays_overlap("seen", definition_sources)


def advanced_coded_batch(long: DataFrame, definitions: Iterable[CodedDefinition], roster: DataFrame | None = None,
                         undecided: bool = False) -> DataFrame:
    """All definitions in one pass: (sample_ID, phenotype, value) of the pairs that are decided.

    Those are cases (1), excluded cases (0), samples that may not serve as controls (null) and, for definitions with
    `missing_as_control`, controls (0). `undecided` adds the other samples with rows in a source of a definition, or of the
    roster, with null: a row for every pair. `long` holds the rows of every source, named in its `source` column.
    """
    definitions = _checked(definitions)
    rest = [d for d in definitions if d.missing_as_control or undecided]
    samples = _of_roster(_per_sample(long, definitions, everyone=bool(rest) and roster is None), roster)
    own = F.transform(F.map_entries("verdicts"), lambda e: F.struct(
        e["key"].alias("phenotype"), F.when(e["value"] != NOT_A_CONTROL, e["value"]).cast("int").alias("value")))
    cells = F.coalesce(own, F.array().cast("array<struct<phenotype:string,value:int>>"))
    if rest:
        others = F.array(*[F.struct(
            F.lit(d.column).alias("phenotype"), F.lit(0 if d.missing_as_control else None).cast("int").alias("value"),
            F.array(*map(F.lit, _sources(d))).alias("sources")) for d in rest])
        free = F.filter(others, lambda o: ~F.coalesce(F.map_contains_key("verdicts", o["phenotype"]), F.lit(False)) & _seen_in(o["sources"]))
        cells = F.concat(cells, F.transform(free, lambda o: F.struct(o["phenotype"].alias("phenotype"), o["value"].alias("value"))))
    return samples.select("sample_ID", F.inline(cells))


def advanced_coded_matrix(long: DataFrame, definitions: Iterable[CodedDefinition],
                          roster: DataFrame | None = None) -> DataFrame:
    """All definitions as columns: (sample_ID, one column per definition), a row for every sample."""
    definitions = _checked(definitions)
    samples = _of_roster(_per_sample(long, definitions, everyone=roster is None), roster)

    def column(d: CodedDefinition) -> Column:
        verdict = F.try_element_at("verdicts", F.lit(d.column))
        control = F.when(_seen_in(F.array(*map(F.lit, _sources(d)))), 0) if d.missing_as_control else F.lit(None)
        return F.when(verdict.isNull(), control).when(verdict != NOT_A_CONTROL, verdict).cast("int").alias(d.column)

    return samples.select("sample_ID", *map(column, definitions))


def advanced_coded(long: DataFrame, definition: CodedDefinition, roster: DataFrame | None = None) -> DataFrame:
    """One definition as a column: (sample_ID, {output_name})."""
    if "source" not in long.columns:
        names = {s.from_phenotype for s in definition.sources}
        if len(names) > 1:
            raise ValueError("several sources need a `source` column in the long table")
        long = long.withColumn("source", F.lit(names.pop()))
    return advanced_coded_matrix(long, [definition], roster)
