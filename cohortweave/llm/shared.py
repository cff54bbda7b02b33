"""Helpers of several operators: places in a global order, connected components, bit filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortweave.runtime import Scope, settle


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """25 bytes that tell rows apart by doc_id and text together (128 bits of hash) and sort by doc_id, a null one first."""
    number = F.col(doc_id).cast("long")
    digits = lambda c: F.lpad(F.hex(c), 16, "0")
    known = F.concat(F.lit("01"), digits(number.bitwiseXOR(F.lit(-(1 << 63)))))
    return F.unhex(F.concat(F.coalesce(known, F.lit("00" + "0" * 16)), digits(F.xxhash64(text)), digits(F.xxhash64(F.lit(1), text))))


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], size: str | None = None) -> DataFrame:
    """`df` with `_rank` (from 0) in its group, and `_before`, the sum of `size` over earlier rows.

    No task holds a group: the rows are range-partitioned by (group, order), written once (a second
    sampling could choose other ranges), and each partition learns from one small row per partition
    and group how much lies before it. `order` should tell rows apart.
    """
    group = list(group)
    dealt = df.repartitionByRange(*[F.col(g) for g in group], *order)
    dealt = dealt.sortWithinPartitions(*[F.col(g) for g in group], *order).withColumn("_mid", F.monotonically_increasing_id())
    dealt = settle(dealt).withColumn("_part", F.shiftright("_mid", 33))
    total = [F.sum(size).alias("_sum")] if size else [F.lit(0).cast("long").alias("_sum")]
    parts = dealt.groupBy("_part", *group).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"), *total)
    earlier = W.partitionBy(*(group or [F.lit(0)])).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("_part", *[F.col(g).alias(f"_g_{g}") for g in group], "_first",
                         F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
                         F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_s0"))
    same = reduce(lambda x, g: x & F.col(g).eqNullSafe(F.col(f"_g_{g}")), group, F.col("_part") == F.col("_p"))
    out = dealt.join(parts.withColumnRenamed("_part", "_p"), same)
    out = out.withColumn("_rank", F.col("_mid") - F.col("_first") + F.col("_n0"))
    if size:
        within = W.partitionBy("_part", *group).orderBy("_mid").rowsBetween(W.unboundedPreceding, -1)
        out = out.withColumn("_before", F.coalesce(F.sum(size).over(within), F.lit(0)) + F.col("_s0"))
    return out.drop("_mid", "_part", "_p", "_first", "_n0", "_s0", *[f"_g_{g}" for g in group])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected `edges` (a, b: long): (node, root), one row per node.

    Randomised contraction: in each round every node moves to the neighbour (or itself) that comes
    first in a fresh random order, and edges are renamed; in expectation at least a quarter of the
    nodes goes each time, whatever the shape of the graph. A node of any degree costs one combined
    minimum. Every round is written to the shared folder, so a lost executor costs one round.
    """
    with Scope() as scope:
        moves, live = [], settle(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct())
        turn = 0
        while not live.isEmpty():
            turn += 1
            order = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
            ends = live.select("a", "b").union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
            move = settle(ends.groupBy("a").agg(F.least(F.min(order("b")), F.first(order("a")))["id"].alias("to"))
                          .withColumnRenamed("a", "node"))
            moves.append(move)
            left, right = move.toDF("a", "ta"), move.toDF("b", "tb")
            before, live = live, settle(live.join(left, "a").join(right, "b").where("ta <> tb")
                                        .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
            scope.drop(before)
        if not moves:
            out = live.select(F.col("a").alias("node"), F.col("b").alias("root"))
        else:
            out = moves[-1].toDF("node", "root")
        for move in reversed(moves[:-1]):
            later = out.toDF("to", "later")
            out = move.join(later, "to", "left").select("node", F.coalesce("later", "to").alias("root"))
        out = settle(out)
        scope.drop_but(out)
        return out


def bit_filter(ids: DataFrame, bits: int = 1 << 20) -> DataFrame:
    """One row: an array of bits/64 longs in which the bit of every id's hash is set.

    Its size is fixed (128 KB), so it may stand as a constant beside any table. When it fills up it lets
    more rows through, and the join behind it decides alone.
    """
    place = ids.select(F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(bits)).alias("p")).distinct()
    words = place.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(p & 63 AS INT)))").alias("v"))
    every = ids.sparkSession.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("v"))
    every = every.union(words).groupBy("w").agg(F.max(F.struct(F.col("v") != 0, "v"))["v"].alias("v"))
    return every.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda x: x["v"]).alias("bits"))


def may_hold(ids: DataFrame, column: Column, bits: int = 1 << 20) -> Column:
    """Whether `column` may be among `ids` (one column of the same type): false only when it is not."""
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    word = F.get(bit_filter(ids, bits).scalar(), F.shiftright(place, 6).cast("int"))
    return F.call_function("shiftright", word, place.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
