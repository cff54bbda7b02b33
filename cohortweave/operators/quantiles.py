"""Exact quantiles in one plan, whatever the sizes of the groups and however close their values are.

1. Equal values of a group are counted, combined on the map side.
2. The counts are range-partitioned by (keys, value) and written once: a large group spreads over
   many tasks, also when all its values are near each other.
3. One small row per group and partition tells where in its group each partition starts, hence
   which partitions hold the wanted ranks.
4. Only in those the running total is taken; the two neighbours of each position are interpolated.

No task holds a group, and no group's answer depends on the groups beside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortweave.functions.values import as_number
from cohortweave.runtime import quoted, settle


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: Column, probabilities: Sequence[float],
                    weight: Column | None = None) -> DataFrame:
    """Linear-interpolated quantiles per group: (*keys, n, quantiles array<double>).

    Null values and rows with a null key are left out; a group without values gives no row. With a `weight` (a whole number) a row stands
    for so many equal ones.
    """
    names, keys = list(keys), [quoted(k) for k in keys]
    times = [] if weight is None else [weight.cast("long").alias("_times")]
    present = df.select(*keys, value.cast("double").alias("_v"), *times).dropna(subset=[*names, "_v"])
    counts = present.groupBy(*keys, "_v").agg((F.sum("_times") if times else F.count("_v")).alias("_w"))
    dealt = counts.repartitionByRange(*[F.col(k) for k in keys], F.col("_v")).withColumn("_part", F.spark_partition_id())
    # written, as a second sampling could choose other ranges
    dealt = settle(dealt)

    position = [f"({float(p)!r}d * (_n - 1))" for p in probabilities]
    low = [f"CAST(floor({p}) AS BIGINT)" for p in position]
    high = [f"CAST(ceil({p}) AS BIGINT)" for p in position]
    ranks = ", ".join(dict.fromkeys(low + high))

    group = W.partitionBy(*keys)
    earlier = group.orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = (
        dealt.groupBy(*keys, "_part").agg(F.sum("_w").alias("_size"))
        .withColumns({"_n": F.sum("_size").over(group), "_end": F.sum("_size").over(earlier)})
        .where(f"exists(array({ranks}), r -> r >= _end - _size AND r < _end)")
        .selectExpr(*keys, "_part", "_n", "_end - _size AS _start")
    )
    inside = W.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = (
        dealt.join(parts, [*names, "_part"])
        .withColumn("_end", F.sum("_w").over(inside) + F.col("_start"))
        .where(f"exists(array({ranks}), r -> r >= _end - _w AND r < _end)")
    )
    picks = [
        F.expr(f"max(CASE WHEN {rank} >= _end - _w AND {rank} < _end THEN _v END) AS {side}{i}")
        for i, pair in enumerate(zip(low, high)) for side, rank in zip(("_lo", "_hi"), pair)
    ]
    # Equal neighbours are returned untouched, so ties with data values stay exact.
    values = ", ".join(
        f"CASE WHEN _lo{i} = _hi{i} THEN _lo{i} ELSE (ceil({p}) - {p}) * _lo{i} + ({p} - floor({p})) * _hi{i} END"
        for i, p in enumerate(position))
    return ranked.groupBy(*keys, "_n").agg(*picks).selectExpr(*keys, "_n AS n", f"array({values}) AS quantiles")


def column_quantiles(df: DataFrame, wanted: dict[str, Sequence[float]]) -> DataFrame:
    """Quantiles of whole columns in one row: a struct (n, q) per column.

    The columns are unpivoted and selected together, so the table is read once, not once per column.
    """
    names = list(wanted)
    probabilities = sorted({float(p) for ps in wanted.values() for p in ps})
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_c"), as_number(df, name).alias("_x")) for i, name in enumerate(names)
    ])).alias("_cell")).select("_cell.*")
    found = exact_quantiles(cells, ["_c"], F.col("_x"), probabilities)

    def own(i, name):
        places = ", ".join(f"get(quantiles, {probabilities.index(float(p))})" for p in wanted[name])
        cell = f"named_struct('n', n, 'q', array({places}))"
        return F.expr(f"max(CASE WHEN _c = {i} THEN {cell} END)").alias(name)

    return found.groupBy().agg(*[own(i, name) for i, name in enumerate(names)])
