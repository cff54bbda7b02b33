"""Cleaning with its reports: outlier rule, scale and what they did, from two passes over the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.values import as_number
from cohortweave.operators.clean import OutlierRule, _same_type, _targets
from cohortweave.operators.quantiles import exact_quantiles
from cohortweave.runtime import Scope, settle


@dataclass(frozen=True)
class Cleaned:
    rows: DataFrame  # as `scale_filter(outlier_filter(...))` leaves them
    outliers: DataFrame  # phenotype, n_total, n_capped, n_removed; empty without an outlier rule
    scales: DataFrame  # phenotype, method, n, mean, sd, lo, hi of the values after the outlier rule


def _moments(counts: DataFrame, value: str) -> DataFrame:
    """(phenotype, n, mean, sd, lo, hi) of values that stand `times` times; sd from deviations, so near-equal large values keep theirs."""
    counts = counts.where(F.col(value).isNotNull())
    n, x = F.sum("times"), F.col(value)
    plain = counts.groupBy("phenotype").agg(n.alias("n"), (F.sum(x * F.col("times")) / n).alias("mean"), F.min(x).alias("lo"), F.max(x).alias("hi"))
    apart = counts.join(plain.select("phenotype", "mean"), "phenotype").groupBy("phenotype").agg(
        F.sum(F.col("times") * (x - F.col("mean")) * (x - F.col("mean"))).alias("square"))
    sd = F.when(F.col("n") > 1, F.sqrt(F.col("square") / (F.col("n") - 1)))
    return plain.join(apart, "phenotype").select("phenotype", "n", "mean", sd.alias("sd"), "lo", "hi")


def _fences(counts: DataFrame, rule: OutlierRule) -> DataFrame:
    if rule.method == "iqr":
        spread = exact_quantiles(counts, ["phenotype"], F.col("number"), [0.25, 0.75], F.col("times"))
        q1, q3 = F.get("quantiles", F.lit(0)), F.get("quantiles", F.lit(1))
        middle, reach = (q1, q3), rule.iqr_multiplier * (q3 - q1)
    else:
        spread = _moments(counts, "number")
        middle, reach = (F.col("mean"), F.col("mean")), rule.zscore_sd * F.col("sd")
    return spread.select("phenotype", (middle[0] - reach).alias("low"), (middle[1] + reach).alias("high"), F.lit(True).alias("fenced"))


def _limited(value: Column, rule: OutlierRule) -> Column:
    """`value` under the fences beside it, itself where there are none."""
    low, high = F.col("low"), F.col("high")
    if rule.mode == "cap":
        new = F.when(value.isNotNull(), F.least(F.greatest(value, low), high))
    else:
        new = F.when((value >= low) & (value <= high), value)
    return F.when(F.col("fenced"), new).otherwise(value)


def clean_with_reports(long: DataFrame, rule: OutlierRule = OutlierRule(), scale: str | None = None,
                       phenotypes: list[str] | None = None) -> Cleaned:
    """Outlier rule and scale in one go, with reports of both.

    The rows are read twice in all: once to count equal values of a phenotype, combined on the map side and written, and once to be
    changed. Fences, the values that a rule changes and the statistics of what it leaves all follow from the counts.
    `scale`: zscore, minmax, or none. Values that are no numbers count in `n_total` alone; a phenotype without any number
    is left as it is and has no report; rows of other data types pass unchanged.
    """
    value = as_number(long, "value")
    with Scope() as scope:
        counts = settle(long.where(_targets(long, phenotypes)).groupBy("phenotype", value.alias("number")).agg(F.count(F.lit(1)).alias("times")))
        fenced = rule.method in ("iqr", "zscore")
        if fenced:
            counts_limited = counts.join(settle(_fences(counts, rule)), "phenotype", "left")
        else:
            counts_limited = counts.selectExpr("*", "CAST(NULL AS DOUBLE) AS low", "CAST(NULL AS DOUBLE) AS high", "false AS fenced")
        limited = settle(counts_limited.withColumn("new", _limited(F.col("number"), rule)))
        capped, removed = F.col("new") != F.col("number"), F.col("new").isNull() & F.col("number").isNotNull()
        outliers = settle(limited.where("fenced").groupBy("phenotype").agg(
            F.sum("times").alias("n_total"), F.coalesce(F.sum(F.when(capped, F.col("times"))), F.lit(0)).alias("n_capped"),
            F.coalesce(F.sum(F.when(removed, F.col("times"))), F.lit(0)).alias("n_removed")))
        scales = settle(_moments(limited, "new").withColumn("method", F.lit(scale)))
        shift, unit = {"zscore": ("mean", "sd"), "minmax": ("lo", "hi - lo")}.get(scale, ("NULL", "NULL"))
        settings = limited.groupBy("phenotype").agg(F.first("low").alias("low"), F.first("high").alias("high"), F.first("fenced").alias("fenced"))
        settings = settle(settings.join(scales.selectExpr("phenotype", f"CAST({shift} AS DOUBLE) AS shift", f"CAST({unit} AS DOUBLE) AS unit"), "phenotype", "left"))
        scope.drop_but(outliers, scales, settings)
    held = long.select(F.struct("*").alias("row"), "phenotype", value.alias("number"), _targets(long, phenotypes).alias("target"))
    new = _limited(F.col("number"), rule)
    changed = F.when(F.col("shift").isNull(), new).when(F.col("unit") > 0, (new - F.col("shift")) / F.col("unit")).otherwise(new - F.col("shift"))
    hit = F.col("target") & (F.coalesce("fenced", F.lit(False)) | F.col("shift").isNotNull())
    out = held.join(settings, "phenotype", "left").withColumn("value", F.when(hit, _same_type(long, changed)).otherwise(F.col("row.value")))
    rows = out.select(*[F.col("value") if c == "value" else F.col(f"row.`{c}`") for c in long.columns])
    return Cleaned(rows, outliers, scales.select("phenotype", "method", "n", "mean", "sd", "lo", "hi"))
