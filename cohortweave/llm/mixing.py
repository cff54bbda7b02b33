"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled and laid end to end, as often as the target allows, and cut into blocks of equal
words. Slot t of the schedule has the golden-ratio point frac(t * phi), which falls into the share of one source in
[0, 1); the j-th slot of a source takes its j-th block. A prefix of the schedule has every source near its share at any length.

Everything is DataFrame functions. A source with a third of all rows is spread by its shuffle order; slots are
ranked in chunks; points meet shares in an equality on a cell of [0, 1).

Defined results: a null text has no words; a null source is a source of its own and comes last; rows repeated under
a doc_id are documents of their own; an empty table, or one without words, takes nothing; columns of other names are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortweave.llm.shared import ranked, whole_text
from cohortweave.runtime import quoted, settle

WEIGHTS = (5, 2, 1)
PHI = 0.6180339887498949  # the golden ratio's fraction
WORD = r"[^\x20\x09-\x0D]+"
CELLS = 1024


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, size); one row per source, so one task is enough.

    The total is shared by weight; targets end at `most` times their source's size and the excess is shared again. Sources
    that end there are those with the least size per weight, so one running sum in that order finds the last level.
    """
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last()))
    cycle = F.element_at(F.lit(list(weights)), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    own = own.withColumn("weight", cycle.cast("long"))
    rising = W.partitionBy(F.lit(0)).orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = rising.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(F.lit(0))
    own = own.withColumns({
        "_total": F.sum("source_size").over(everything),
        "_left": F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
        "_weights": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))})
    # a source is above its bound when the level of those from it on is
    own = own.withColumn("_level", F.when(F.col("_left") * F.col("weight") <= most * F.col("source_size") * F.col("_weights"),
                                          F.col("_left") / F.col("_weights")))
    own = own.withColumn("_level", F.max("_level").over(everything))
    target = F.least(F.col("_level") * F.col("weight"), (most * F.col("source_size")).cast("double"))
    return own.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def schedule(targets: DataFrame, block: int, chunk: int = 4096) -> DataFrame:
    """(slot, source, block): slots from 0 up; the blocks of a source come in order, each once."""
    share = W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    shares = targets.where("target > 0").select(
        "source", "target", F.sum("target").over(W.partitionBy(F.lit(0))).alias("_all"),
        F.sum("target").over(share.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("_end"))
    shares = shares.select("source", ((F.col("_end") - F.col("target")) / F.col("_all")).alias("_lo"),
                           F.when(F.lead("_end").over(share).isNull(), 1.0).otherwise(F.col("_end") / F.col("_all")).alias("_hi"))
    cells = shares.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_lo") * CELLS), F.floor(F.col("_hi") * CELLS))))
    total = targets.agg(F.ceil(F.coalesce(F.sum("source_size"), F.lit(0)) / block).cast("long")).first()[0]
    spark = targets.sparkSession
    points = spark.range(total).withColumnRenamed("id", "slot").withColumn("_part", F.floor(F.col("slot") / (1 << 20)))
    # exact to 2^-30 at any slot: the fraction is summed from the upper and the lower bits
    high = F.col("_part") * F.lit((PHI * (1 << 20)) % 1.0)
    x = F.col("slot") % (1 << 20) * F.lit(PHI) + (high - F.floor(high))
    points = points.withColumn("_x", x - F.floor(x)).withColumn("_cell", F.floor(F.col("_x") * CELLS))
    drawn = points.join(cells, "_cell").where("_x >= _lo AND _x < _hi").select(
        "slot", "source", F.floor(F.col("slot") / chunk).alias("_chunk"))
    counts = drawn.groupBy("source", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_wide", F.floor(F.col("_chunk") / chunk))
    wide = counts.groupBy("source", "_wide").agg(F.sum("_n").alias("_m"))
    so_far = W.partitionBy("source").orderBy("_wide").rowsBetween(W.unboundedPreceding, -1)
    wide = wide.select(F.col("source").alias("_s2"), F.col("_wide").alias("_w2"), F.coalesce(F.sum("_m").over(so_far), F.lit(0)).alias("_m0"))
    near = W.partitionBy("source", "_wide").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("_n0", F.coalesce(F.sum("_n").over(near), F.lit(0)))
    starts = counts.join(wide, F.col("source").eqNullSafe(F.col("_s2")) & (F.col("_wide") == F.col("_w2"))).select(
        F.col("source").alias("_s1"), F.col("_chunk").alias("_c1"), (F.col("_n0") + F.col("_m0")).alias("_start"))
    inside = W.partitionBy("source", "_chunk").orderBy("slot")
    numbered = drawn.withColumn("_i", F.row_number().over(inside) - 1)
    return numbered.join(starts, F.col("source").eqNullSafe(F.col("_s1")) & (F.col("_chunk") == F.col("_c1"))).select(
        "slot", "source", (F.col("_start") + F.col("_i")).alias("block"))


def mix(rows: DataFrame, block: int = 64, weights: Sequence[int] = WEIGHTS, most: int = 3, seed: str = "mix") -> DataFrame:
    """The mix, piece by piece: (slot, source, block, row, epoch, start, length).

    `rows`: (row, doc_id, source, size), `row` unique. A piece is the words [start, start + length) of a row that
    the block of a slot holds; the pieces of a row and epoch are adjacent. `epoch` counts the passes over a source.
    """
    rows = rows.where("size > 0")
    targets = settle(source_targets(rows, weights, most))
    shuffled = ranked(rows, ["source"], [F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))),
                                         F.col("doc_id"), F.col("size"), F.col("row")], "size")
    known = targets.select(F.col("source").alias("_s"), F.col("source_size").alias("_all"), F.col("target").alias("_target"))
    laid = shuffled.join(known, F.col("source").eqNullSafe(F.col("_s")))
    last = F.least(F.lit(most - 1), F.floor((F.col("_target") + 8 * block) / F.col("_all"))).cast("int")
    laid = laid.withColumn("epoch", F.explode(F.sequence(F.lit(0), last)))
    laid = laid.withColumn("_at", F.col("epoch") * F.col("_all") + F.col("_before"))
    first, end = F.floor(F.col("_at") / block), F.floor((F.col("_at") + F.col("size") - 1) / block)
    pieces = laid.select(F.col("source").alias("_s"), "row", "epoch", "size", "_at", F.explode(F.sequence(first, end)).alias("_block"))
    slots = schedule(targets, block)
    found = slots.join(pieces, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_block")))
    start = F.greatest(F.col("_at"), F.col("block") * block)
    return found.select("slot", "source", "block", "row", "epoch", (start - F.col("_at")).alias("start"),
                        (F.least(F.col("_at") + F.col("size"), (F.col("block") + 1) * block) - start).alias("length"))


def sized_rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, source, size), written once: the texts are read a single time."""
    return settle(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "source",
                              word_count(whole_text()).alias("size")))


def taken_words(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row: the words the mix takes of it, repeats counted."""
    rows = sized_rows(docs)
    words = mix(rows, **settings).groupBy("row").agg(F.sum("length").alias("taken"))
    bounds = {k: settings[k] for k in ("weights", "most") if k in settings}
    targets = source_targets(rows, **bounds).withColumnRenamed("source", "_s")
    out = rows.join(targets, F.col("source").eqNullSafe(F.col("_s"))).join(words, "row", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """`docs` as the mix has them: a row for each pass over a document, cut to the words taken in that pass.

    A document taken whole keeps its text as it is; of a part the words after the last one taken go.
    """
    held = settle(docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row")))
    rows = settle(held.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), "doc.source",
                              word_count(whole_text("doc.text")).alias("size")))
    parts = mix(rows, **settings).groupBy("row", "epoch").agg(F.sum("length").alias("words"))
    parts = parts.join(rows.select("row", "size"), "row")
    # possessive, so that the expression runs in a loop however many words there are
    first_words = F.concat(F.lit(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), F.col("words").cast("string"), F.lit("}+"))
    text = F.when(F.col("words") == F.col("size"), F.col("doc.text")).otherwise(
        F.call_function("regexp_extract", F.col("doc.text"), first_words, F.lit(0)))
    out = held.join(parts, "row").withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*[F.col(c) if c in ("text", "n_chars") else F.col(f"doc.{quoted(c)}") for c in docs.columns])
