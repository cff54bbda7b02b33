"""Categorical phenotypes: presence, dictionary codes and one-hot columns per sample."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.operators.coded import MAX_PIVOT_COLUMNS
from cohortweave.runtime import local_table


@dataclass(frozen=True)
class CategoricalSpec:
    """How one phenotype is encoded: a dictionary beats one-hot, one-hot beats presence."""

    phenotype: str
    output_name: str | None = None
    dictionary: dict | None = None
    one_hot: bool = False
    categories: Iterable | None = None
    min_occurrences: int = 1
    missing_as_control: bool = False

    @property
    def column(self) -> str:
        return self.output_name or self.phenotype

    @property
    def mode(self) -> str:
        return "dictionary" if self.dictionary else "one_hot" if self.one_hot else "binary"

    def codes(self) -> dict:
        """Dictionary inverted: code -> texts, smallest code first; 'NA' entries are left out."""
        out: dict = {}
        for text, code in self.dictionary.items():
            if code is not None and str(code) != "NA":
                out.setdefault(code, []).append(str(text))
        texts = any(isinstance(code, str) for code in out)  # numbers and texts together are ordered as text
        return dict(sorted(out.items(), key=lambda item: str(item[0]) if texts else item[0]))


def list_categories(long: DataFrame, spec: CategoricalSpec, limit: int = MAX_PIVOT_COLUMNS) -> list[str]:
    """Sorted distinct values, among samples with enough rows, for use as one-hot columns."""
    rows = long.where((F.col("phenotype") == spec.phenotype))
    if spec.min_occurrences > 1:
        per_sample = rows.groupBy("sample_ID").agg(F.count(F.lit(1)).alias("n"))
        rows = rows.join(per_sample.where(F.col("n") >= spec.min_occurrences), "sample_ID", "left_semi")
    text = F.col("value").cast("string")
    found = rows.where(text.isNotNull()).select(text).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{spec.phenotype}: more than {limit} categories cannot be columns")
    return sorted(r[0] for r in found)


def _value_counters(specs: list[CategoricalSpec]) -> list[tuple[str, str, str]]:
    """(counter, phenotype, text) for every value an encoding looks at."""
    out = []
    for i, spec in enumerate(specs):
        if spec.mode == "dictionary":
            out += [(f"n{i}_{k}", spec.phenotype, t) for k, texts in enumerate(spec.codes().values()) for t in texts]
        elif spec.mode == "one_hot":
            out += [(f"n{i}_{k}", spec.phenotype, str(c)) for k, c in enumerate(spec.categories)]
    return out


def _count_by_lookup(rows: DataFrame, specs: list[CategoricalSpec], counters) -> DataFrame:
    """All counters of a sample: values find theirs by a hash join, whatever their number, and are counted on the map side."""
    counters = list(dict.fromkeys(counters + [(f"n{i}", s.phenotype, None) for i, s in enumerate(specs)]))
    wanted = local_table(
        rows.sparkSession, dict(zip(("counter", "_phenotype", "_text"), map(list, zip(*counters)))),
        dict.fromkeys(("counter", "_phenotype", "_text"), pa.string()))
    # A null text in the lookup stands for the total of the phenotype.
    keyed = rows.withColumn("_key", F.explode(F.array_distinct(F.array("text", F.lit(None)))))
    hits = keyed.join(wanted, (F.col("phenotype") == F.col("_phenotype")) & F.col("_key").eqNullSafe(F.col("_text")))
    names = list(dict.fromkeys(c for c, _, _ in counters))
    return hits.groupBy("sample_ID").pivot("counter", names).agg(F.count(F.lit(1))).na.fill(0)


def _most_frequent(counts: list[Column], codes: list) -> Column:
    """The code with the highest count, the smallest on ties, null when all are zero."""
    if not codes:
        return F.lit(None)
    top = F.greatest(*counts) if len(counts) > 1 else counts[0]
    first = F.coalesce(*[F.when(n == top, F.lit(code)) for n, code in zip(counts, codes)])
    return F.when(top > 0, first)


def _encoded(i: int, spec: CategoricalSpec, short_as_zero: bool) -> list[Column]:
    n = F.coalesce(F.col(f"n{i}"), F.lit(0))
    absent = F.lit(0) if spec.missing_as_control else F.lit(None)
    short = (n > 0) & (n < spec.min_occurrences)

    def cell(value: Column, kind: str = "int") -> Column:
        out = F.when(n == 0, absent)
        if not short_as_zero:
            out = out.when(short, F.lit(None))
        return out.otherwise(value).cast(kind)

    if spec.mode == "dictionary":
        codes = spec.codes()
        kinds = {type(c) for c in codes}
        kind = "int" if kinds <= {int, bool} else "double" if kinds <= {int, bool, float} else "string"
        counts = [F.col(f"n{i}_{k}") for k in range(len(codes))]
        return [cell(_most_frequent(counts, list(codes)), kind).alias(spec.column)]
    if spec.mode == "one_hot":
        return [cell((F.col(f"n{i}_{k}") > 0).cast("int")).alias(f"{spec.column}_{c}")
                for k, c in enumerate(spec.categories)]
    return [cell((n >= spec.min_occurrences).cast("int")).alias(spec.column)]


def categorical_matrix(long: DataFrame, specs: Iterable[CategoricalSpec], roster: DataFrame | None = None,
                       short_as_zero: bool = False) -> DataFrame:
    """Encode many phenotypes in one scan: (sample_ID, columns of each spec).

    A sample with fewer rows than `min_occurrences` gets null in all columns of the phenotype. With
    `short_as_zero` presence is 0 for it instead and the other encodings take its rows as they are.
    """
    specs = list(specs)
    for spec in list(specs):
        if spec.mode == "one_hot":
            found = list(spec.categories or list_categories(long, spec))  # the caller's specification stays as it is
            specs[specs.index(spec)] = replace(spec, categories=found)
    rows = long.where(F.col("phenotype").isin(*[s.phenotype for s in specs]) & F.col("sample_ID").isNotNull()).select(
        "sample_ID", "phenotype", F.col("value").cast("string").alias("text"))
    table = _count_by_lookup(rows, specs, _value_counters(specs))
    if roster is not None:
        table = roster.select("sample_ID").join(table, "sample_ID", "left")
    return table.select("sample_ID", *[c for i, s in enumerate(specs) for c in _encoded(i, s, short_as_zero)])


def categorical(long: DataFrame, spec: CategoricalSpec, roster: DataFrame | None = None) -> DataFrame:
    """Encode one phenotype; without a roster the samples are those in the data."""
    return categorical_matrix(long, [spec], roster)


def categorical_matrix_multi(long: DataFrame, specs: Iterable[CategoricalSpec]) -> DataFrame:
    """Many phenotypes over all samples of the input; too few rows count as absence (0)."""
    roster = long.where(F.col("sample_ID").isNotNull()).select("sample_ID").distinct()
    return categorical_matrix(long, specs, roster, short_as_zero=True)
