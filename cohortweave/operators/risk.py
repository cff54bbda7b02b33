"""Risk classes of summary columns: percentile, threshold and quantile-bin rules."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.values import as_number
from cohortweave.operators.quant import bin_edges, bin_number
from cohortweave.operators.quantiles import column_quantiles
from cohortweave.runtime import quoted, settle

log = logging.getLogger(__name__)

METHODS = ("percentile", "threshold", "quantile_bin")


@dataclass(frozen=True)
class RiskRule:
    method: str
    source_col: str
    output_col: str
    stat: str = "mean"
    high: float | None = None
    low: float | None = None
    cutoffs: tuple[float, ...] | None = None
    n: int | None = None
    labels: tuple[str, ...] | None = None

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"unknown risk method {self.method!r}, expected one of {', '.join(METHODS)}")
        if self.cutoffs is not None and list(self.cutoffs) != sorted(self.cutoffs):
            raise ValueError(f"{self.output_col}: cutoffs must rise")
        classes = self.n if self.method == "quantile_bin" else len(self.cutoffs) + 1 if self.cutoffs is not None else None
        if self.labels and classes and len(self.labels) < classes:
            raise ValueError(f"{self.output_col}: {classes} classes need as many labels, not {len(self.labels)}")

    @classmethod
    def for_phenotype(cls, output_name: str, settings: dict) -> RiskRule:
        """The rule of one quantitative phenotype, from its `risk_classification` settings."""
        stat = settings.get("stat", "mean")
        return cls(
            method=settings["method"], source_col=f"{output_name}_{stat}", output_col=f"{output_name}_risk", stat=stat,
            high=settings.get("high"), low=settings.get("low"), n=settings.get("n"),
            cutoffs=tuple(settings["cutoffs"]) if settings.get("cutoffs") is not None else None,
            labels=tuple(settings["labels"]) if settings.get("labels") else None,
        )

    def probabilities(self) -> list[float]:
        """Quantiles of the source column the rule needs."""
        if self.method == "quantile_bin":
            return bin_edges(self.n)
        if self.method == "percentile":
            wanted = self.cutoffs if self.cutoffs is not None else [p for p in (self.high, self.low) if p is not None]
            return [p / 100 for p in wanted]
        return []

    def classes(self) -> list[tuple[str, object]]:
        """(name, value) of every class the rule can give."""
        if self.is_binary:
            return [("0.0", 0.0), ("1.0", 1.0)]
        count = self.n if self.method == "quantile_bin" else len(self.cutoffs) + 1
        if self.labels:
            return [(label, label) for label in self.labels[:count]]
        return [(str(i), i) for i in range(count)]

    @property
    def is_binary(self) -> bool:
        if self.method == "quantile_bin":
            return self.high is not None or self.low is not None
        return self.cutoffs is None


class _Cutoffs:
    """Access to the data-driven cutoffs, a single row attached to the table as `_cut`."""

    def __init__(self, rules: list[RiskRule]):
        self.wanted: dict[str, list[float]] = {}
        for rule in rules:
            ps = self.wanted.setdefault(rule.source_col, [])
            ps += [p for p in rule.probabilities() if p not in ps]
        self.wanted = {name: ps for name, ps in self.wanted.items() if ps}

    def find(self, wide: DataFrame) -> None:
        """Select the cutoffs; the one row is written, for matrix and report alike."""
        if self.wanted:
            packed = F.struct(*[F.col(quoted(name)).alias(f"c{i}") for i, name in enumerate(self.wanted)])
            self.row = settle(column_quantiles(wide, self.wanted).select(packed.alias("cut")))

    def attach(self, to: DataFrame) -> DataFrame:
        return to.withColumn("_cut", self.row.scalar()) if self.wanted else to

    def at(self, rule: RiskRule, probability: float) -> Column:
        place = list(self.wanted).index(rule.source_col)
        return F.get(F.col(f"_cut.c{place}.q"), F.lit(self.wanted[rule.source_col].index(probability)))

    def edges(self, rule: RiskRule) -> Column:
        """Bin edges with equal neighbours dropped; null without data."""
        edges = F.array(*[self.at(rule, p) for p in rule.probabilities()])
        return F.when(self.at(rule, 0.0).isNotNull(), F.array_distinct(edges))


def _level(x: Column, cuts: list[Column], labels) -> Column:
    """How many cutoffs lie below x, as number or label."""
    number = bin_number(x, cuts)
    return F.get(F.array(*[F.lit(label) for label in labels]), number) if labels else number


def _flag(x: Column, hit: Column) -> Column:
    return F.when(x.isNotNull(), F.when(hit, 1.0).otherwise(0.0))


def _classified(rule: RiskRule, x: Column, cut: _Cutoffs) -> Column:
    if rule.method == "quantile_bin":
        edges = cut.edges(rule)
        bins = F.size(edges) - 1
        inner = F.slice(edges, 2, F.greatest(bins - 1, F.lit(0)))
        number = F.when(x.isNotNull() & (bins > 0), F.size(F.filter(inner, lambda e: e < x)))
        if not rule.is_binary:
            return F.get(F.array(*[F.lit(v) for v in rule.labels]), number) if rule.labels else number
        hit = F.lit(False)
        if rule.high is not None:
            hit = hit | (number >= bins - F.lit(rule.high))
        if rule.low is not None:
            hit = hit | (number < F.lit(rule.low))
        return _flag(number, hit)

    def cutoff(value):
        return cut.at(rule, value / 100) if rule.method == "percentile" else F.lit(float(value))

    if rule.cutoffs is not None:
        return _level(x, [cutoff(c) for c in rule.cutoffs], rule.labels)
    hit = F.lit(False)
    if rule.high is not None:
        hit = hit | (x > cutoff(rule.high))
    if rule.low is not None:
        hit = hit | (x < cutoff(rule.low))
    return _flag(x, hit)


def _usable(wide: DataFrame, rules: Iterable[RiskRule]) -> list[RiskRule]:
    rules = list(rules)
    if not rules:
        log.warning("no risk rules given")
    for rule in rules:
        if rule.source_col not in wide.columns:
            log.warning("risk rule %s skipped: no column %s", rule.output_col, rule.source_col)
    return [r for r in rules if r.source_col in wide.columns]


def _prepared(wide: DataFrame, rules: Iterable[RiskRule]) -> tuple[DataFrame, list[RiskRule], _Cutoffs]:
    rules = _usable(wide, rules)
    cut = _Cutoffs(rules)
    wide = settle(wide) if cut.wanted else wide
    cut.find(wide)
    return wide, rules, cut


def risk_matrix(wide: DataFrame, rules: Iterable[RiskRule]) -> DataFrame:
    """(sample_ID, one class column per rule). Rules on absent columns are skipped.

    The cutoffs of all rules are selected together, then one projection classifies every sample;
    the table itself is never shuffled. It is settled first when cutoffs have to be found in it.
    """
    return _matrix(*_prepared(wide, rules))


def risk_report(wide: DataFrame, rules: Iterable[RiskRule]) -> DataFrame:
    """Cutoffs and class counts: (output_col, method, stat, entry, label, value)."""
    return _report(*_prepared(wide, rules))


def risk_tables(wide: DataFrame, rules: Iterable[RiskRule]) -> tuple[DataFrame, DataFrame]:
    """`risk_matrix` and `risk_report` from the same cutoffs."""
    prepared = _prepared(wide, rules)
    return _matrix(*prepared), _report(*prepared)


def _matrix(wide: DataFrame, rules: list[RiskRule], cut: _Cutoffs) -> DataFrame:
    return cut.attach(wide).select("sample_ID", *[
        _classified(rule, as_number(wide, rule.source_col), cut).alias(rule.output_col) for rule in rules])


def _report(wide: DataFrame, rules: list[RiskRule], cut: _Cutoffs) -> DataFrame:
    classed = cut.attach(wide).select(*[
        c for i, rule in enumerate(rules) for c in (
            as_number(wide, rule.source_col).alias(f"x{i}"),
            _classified(rule, as_number(wide, rule.source_col), cut).alias(f"r{i}"))
    ])
    counts = classed.agg(*[
        c for i, rule in enumerate(rules) for c in (
            F.count(F.when(F.col(f"x{i}").isNull(), 1)).alias(f"na{i}"),
            *[F.count(F.when(F.col(f"r{i}") == value, 1)).alias(f"k{i}_{j}")
              for j, (_, value) in enumerate(rule.classes())])
    ])
    row = cut.attach(counts)

    def line(rule, entry, label, value):
        return F.struct(*[F.lit(v).alias(n) for n, v in (
            ("output_col", rule.output_col), ("method", rule.method), ("stat", rule.stat),
            ("entry", entry), ("label", label))], value.cast("double").alias("value"))

    lines = []
    for i, rule in enumerate(rules):
        lines.append(line(rule, "n_na", "", F.col(f"na{i}")))
        # Classes nobody falls in are not listed.
        lines += [line(rule, "class", name, F.when(F.col(f"k{i}_{j}") > 0, F.col(f"k{i}_{j}")))
                  for j, (name, _) in enumerate(rule.classes())]
        if rule.method == "quantile_bin":
            edges = cut.edges(rule)
            lines.append(line(rule, "n_bins", "", F.size(edges) - 1))
            lines += [line(rule, "bin_edge", str(k), F.round(F.get(edges, F.lit(k)), 4)) for k in range(rule.n + 1)]
            continue

        def cutoff(value):
            return cut.at(rule, value / 100) if rule.method == "percentile" else F.lit(float(value))

        if rule.cutoffs is not None:
            lines += [line(rule, "cutoff", str(c), cutoff(c)) for c in rule.cutoffs]
        else:
            lines += [line(rule, f"{side}_cutoff", "", cutoff(value))
                      for side, value in (("high", rule.high), ("low", rule.low)) if value is not None]
    return row.select(F.explode(F.array(*lines)).alias("line")).select("line.*").where(F.col("value").isNotNull())
