"""Outlier handling and scaling of quantitative values, per phenotype over all samples."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.functions.values import as_number
from cohortweave.operators.quantiles import exact_quantiles
from cohortweave.runtime import settle


@dataclass(frozen=True)
class OutlierRule:
    method: str = "iqr"  # iqr, zscore; anything else leaves the values alone
    mode: str = "cap"  # cap, remove
    iqr_multiplier: float = 1.5
    zscore_sd: float = 3.0


def _targets(long: DataFrame, phenotypes: Iterable[str] | None) -> Column:
    test = F.col("data_type") == "quantitative" if "data_type" in long.columns else F.lit(True)
    test = test & F.col("phenotype").isNotNull()
    if phenotypes:
        test = test & F.col("phenotype").isin(*phenotypes)
    return F.coalesce(test, F.lit(False))


def _same_type(long: DataFrame, number: Column) -> Column:
    return number.cast("string") if isinstance(long.schema["value"].dataType, T.StringType) else number


def outlier_fences(long: DataFrame, rule: OutlierRule, phenotypes: list[str] | None = None) -> DataFrame:
    """Bounds per phenotype: (phenotype, lo, hi). Groups without any number have no row."""
    target = long.where(_targets(long, phenotypes))
    value = as_number(long, "value")
    if rule.method == "iqr":
        spread = exact_quantiles(target, ["phenotype"], value, [0.25, 0.75])
        q1, q3 = F.get("quantiles", F.lit(0)), F.get("quantiles", F.lit(1))
        reach = rule.iqr_multiplier * (q3 - q1)
        return spread.select("phenotype", (q1 - reach).alias("lo"), (q3 + reach).alias("hi"))
    stats = target.groupBy("phenotype").agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.count(value).alias("n"))
    reach = rule.zscore_sd * F.col("sd")
    return stats.where("n > 0").select(
        "phenotype", (F.col("mean") - reach).alias("lo"), (F.col("mean") + reach).alias("hi"))


def _with_fences(long: DataFrame, rule: OutlierRule, phenotypes: list[str] | None) -> DataFrame:
    """Each row with `_old` and `_new` numbers and `_hit`, true where its phenotype has fences."""
    fences = outlier_fences(long, rule, phenotypes).select("phenotype", "lo", "hi", F.lit(True).alias("_fenced"))
    # Settled: a row per phenotype, needed by every later job on the cleaned values, of a size Spark then knows.
    rows = long.join(settle(fences), "phenotype", "left")
    value, lo, hi = as_number(long, "value"), F.col("lo"), F.col("hi")
    if rule.mode == "cap":
        # least and greatest skip nulls: a missing bound does not clip, a missing value must stay missing.
        new = F.when(value.isNotNull(), F.least(F.greatest(value, lo), hi))
    else:
        new = F.when((value >= lo) & (value <= hi), value)
    hit = _targets(long, phenotypes) & F.col("_fenced").isNotNull()
    return rows.withColumns({"_old": value, "_new": new, "_hit": hit})


def outlier_filter(long: DataFrame, rule: OutlierRule = OutlierRule(),
                   phenotypes: list[str] | None = None) -> DataFrame:
    """Cap or blank the outliers of quantitative rows; other rows pass unchanged."""
    if rule.method not in ("iqr", "zscore"):
        return long
    rows = _with_fences(long, rule, phenotypes)
    value = F.when(F.col("_hit"), _same_type(long, F.col("_new"))).otherwise(F.col("value"))
    return rows.withColumn("value", value).select(*long.columns)


def outlier_report(long: DataFrame, rule: OutlierRule = OutlierRule(),
                   phenotypes: list[str] | None = None) -> DataFrame:
    """What `outlier_filter` changes: (phenotype, n_total, n_capped, n_removed)."""
    rows = _with_fences(long, rule, phenotypes).where(F.col("_hit"))
    capped = F.col("_new").isNotNull() & (F.col("_new") != F.col("_old"))
    removed = F.col("_new").isNull() & F.col("_old").isNotNull()
    return rows.groupBy("phenotype").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count(F.when(capped, 1)).alias("n_capped"),
        F.count(F.when(removed, 1)).alias("n_removed"),
    )


def outlier_filter_batch(long: DataFrame, rules: dict[str, OutlierRule]) -> DataFrame:
    """Different rules for different phenotypes in one pass over the rows."""
    by_rule: dict[OutlierRule, list[str]] = {}
    for phenotype, rule in rules.items():
        if rule.method in ("iqr", "zscore"):
            by_rule.setdefault(rule, []).append(phenotype)
    if not by_rule:
        return long
    fences = None
    for rule, phenotypes in by_rule.items():
        part = outlier_fences(long, rule, phenotypes).withColumn("_mode", F.lit(rule.mode))
        fences = part if fences is None else fences.unionByName(part)
    value, lo, hi = as_number(long, "value"), F.col("lo"), F.col("hi")
    new = F.when(F.col("_mode") == "cap", F.when(value.isNotNull(), F.least(F.greatest(value, lo), hi))).otherwise(
        F.when((value >= lo) & (value <= hi), value))
    hit = _targets(long, None) & F.col("_mode").isNotNull()
    rows = long.join(settle(fences), "phenotype", "left")
    return rows.withColumn(
        "value", F.when(hit, _same_type(long, new)).otherwise(F.col("value"))).select(*long.columns)


def scale_stats(long: DataFrame, phenotypes: list[str] | None = None) -> DataFrame:
    value = as_number(long, "value")
    return long.where(_targets(long, phenotypes)).groupBy("phenotype").agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"),
        F.min(value).alias("lo"), F.max(value).alias("hi"),
    ).where("n > 0")


def scale_filter(long: DataFrame, method: str = "zscore", phenotypes: list[str] | None = None) -> DataFrame:
    """Rescale quantitative values; a constant phenotype is only shifted."""
    if method not in ("zscore", "minmax"):
        return long
    stats = scale_stats(long, phenotypes).select(
        "phenotype",
        (F.col("mean") if method == "zscore" else F.col("lo")).alias("_shift"),
        (F.col("sd") if method == "zscore" else F.col("hi") - F.col("lo")).alias("_unit"),
    )
    rows = long.join(settle(stats), "phenotype", "left")
    shifted = as_number(long, "value") - F.col("_shift")
    scaled = F.when(F.col("_unit") > 0, shifted / F.col("_unit")).otherwise(shifted)
    hit = _targets(long, phenotypes) & F.col("_shift").isNotNull()
    return rows.withColumn(
        "value", F.when(hit, _same_type(long, scaled)).otherwise(F.col("value"))).select(*long.columns)


def scale_report(long: DataFrame, method: str = "zscore", phenotypes: list[str] | None = None) -> DataFrame:
    """Parameters `scale_filter` applies, per phenotype."""
    used = {"zscore": ("mean", "sd"), "minmax": ("lo", "hi")}[method]
    return scale_stats(long, phenotypes).select("phenotype", F.lit(method).alias("method"), *used)
