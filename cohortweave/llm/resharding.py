"""Resharding by minimum-cost flow.

From the rows and bytes that the old shards hold and the rows that the new shards may hold, a flow over the
(old, new) pairs settles how many rows go where: staying costs nothing, moving costs bytes. The flow sees shards
only, never documents. Each old shard gives away its smallest documents, so what leaves it costs more a row the more
rows leave; the row at the cut, which may stay or go, has an arc of its own with its own bytes. Hence no other
transfer to such counts moves fewer bytes. Runs of documents in that order are the blocks of a transfer.
`rewrite` writes the files of changed shards only and points at the old files for the others.

Law: `rows`. Shards differ by one document at most, whatever share one old shard, source or text has.

Defined results: a null text has no bytes; a null doc_id is an id of its own (-1 for the law of the old layout);
rows repeated under a doc_id are documents of their own, ties in size and id go by text hash;
an empty table gives an empty result; surplus columns, whatever their names, are carried along by `rewrite`, which writes
each row once, rows with equal (also null) ids and texts included.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.shared import ranked, whole_text
from cohortweave.runtime import quoted


@dataclass
class Arc:
    to: int
    room: int
    cost: int
    back: int  # place of the reverse arc


class Network:
    """Minimum-cost flow by successive shortest paths with potentials; costs are not negative."""

    def __init__(self, nodes: int):
        self.arcs: list[list[Arc]] = [[] for _ in range(nodes)]

    def link(self, a: int, b: int, room: int, cost: int) -> Arc:
        arc = Arc(b, room, cost, len(self.arcs[b]))
        self.arcs[a].append(arc)
        self.arcs[b].append(Arc(a, 0, -cost, len(self.arcs[a]) - 1))
        return arc

    def send(self, source: int, sink: int) -> int:
        potential, sent = [0] * len(self.arcs), 0
        while True:
            far, came, heap = {source: 0}, {}, [(0, source)]
            while heap:
                d, u = heapq.heappop(heap)
                if d > far[u]:
                    continue
                for place, arc in enumerate(self.arcs[u]):
                    reach = d + arc.cost + potential[u] - potential[arc.to]
                    if arc.room and reach < far.get(arc.to, reach + 1):
                        far[arc.to], came[arc.to] = reach, (u, place)
                        heapq.heappush(heap, (reach, arc.to))
            if sink not in far:
                return sent
            longest = max(far.values())
            potential = [p + far.get(v, longest) for v, p in enumerate(potential)]
            path, v = [], sink
            while v != source:
                u, place = came[v]
                path.append(self.arcs[u][place])
                v = u
            step = min(arc.room for arc in path)
            for arc in path:
                arc.room -= step
                self.arcs[arc.to][arc.back].room += step
            sent += step


def transfers(rows: dict[int, int], shards: int, cost: dict[int, list[tuple[int, int]]] | None = None) -> list[tuple[int, int, int]]:
    """(old, new, rows) of the cheapest way to counts that are at most one apart.

    `rows`: rows of each old shard. `cost`: (rows, bytes a row) in the order in which rows would leave it, bytes not falling
    (1 a row if not given). Which shards get the surplus row is part of the solution.
    """
    total = sum(rows.values())
    least, more = divmod(total, shards)
    old = sorted(rows)
    first_new = 1 + 2 * len(old)
    pool, sink = first_new + shards, first_new + shards + 1
    net = Network(sink + 1)
    ways = []
    for i, shard in enumerate(old):
        held, leaving = 1 + 2 * i, 2 + 2 * i
        net.link(0, held, rows[shard], 0)
        for n, size in (cost or {}).get(shard, [(rows[shard], 1)]):
            net.link(held, leaving, n, size)
        ways += [(shard, new, net.link(held if new == shard else leaving, first_new + new, rows[shard], 0)) for new in range(shards)]
    for new in range(shards):
        net.link(first_new + new, sink, least, 0)
        net.link(first_new + new, pool, 1, 0)
    net.link(pool, sink, more, 0)
    if net.send(0, sink) != total:
        raise AssertionError("the shards hold all rows")
    return [(a, b, start - arc.room) for a, b, arc in ways for start in [rows[a]] if start > arc.room]


def leaving_bytes(placed: DataFrame, held: dict[int, int], shards: int) -> dict[int, list[tuple[int, int]]]:
    """What rows cost that leave an old shard: those that have to, the one at the cut, and those before it.

    `placed` ranks rows from the largest. The first and last kind have one price a row, which decides nothing: rows behind
    the cut leave any shard that stays and those before it need not leave.
    """
    least = sum(held.values()) // shards
    rank, size = F.col("_rank"), F.col("size")
    found = placed.groupBy("old_shard").agg(
        F.min(F.when(rank > least, size)).alias("last"), F.max(F.when(rank == least, size)).alias("cut"),
        F.min(F.when(rank < least, size)).alias("kept")).collect()  # a row per old shard
    out = {}
    for r in found:
        n = held[r["old_shard"]]
        pieces = [(n - least - 1, r["last"]), (1, r["cut"]), (least, r["kept"])] if n > least else [(n, r["kept"])]
        out[r["old_shard"]] = [(count, price) for count, price in pieces if count > 0]
    return out


def reshard(docs: DataFrame, old_shard: Column, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, text_hash, old_shard, shard, slot): every row of `docs` in one of `shards` shards.

    `slot` counts the documents of a new shard from 0: those that stayed first, then block after block.
    """
    text = whole_text()
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"), old_shard.cast("int").alias("old_shard"))
    placed = ranked(sized, ["old_shard"], [F.col("size").desc(), F.col("doc_id"), F.col("text_hash")])
    held = {r["old_shard"]: r["n"] for r in placed.groupBy("old_shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks, filled = [], [0] * shards
    flow = transfers(held, shards, leaving_bytes(placed, held, shards))
    for new in range(shards):  # rows that stay come first in the shard
        for a, b, n in flow:
            if a == b == new:
                blocks.append((a, b, 0, n, 0))
                filled[b] += n
    given = {a: n for a, b, n in flow if a == b}
    for a, b, n in sorted(flow):
        if a != b:
            start = given.get(a, 0)
            blocks.append((a, b, start, start + n, filled[b]))
            given[a], filled[b] = start + n, filled[b] + n
    table = docs.sparkSession.createDataFrame(blocks, "_old int, shard int, _from long, _to long, _slot long")
    inside = (F.col("old_shard") == F.col("_old")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    out = placed.join(F.broadcast(table), inside)  # at most one block per pair of shards
    return out.select("doc_id", "size", "text_crc32", "text_hash", "old_shard", "shard", (F.col("_rank") - F.col("_from") + F.col("_slot")).alias("slot"))


def rewrite(docs: DataFrame, placed: DataFrame, folder: str, current: dict[int, str] | None = None) -> dict[int, str]:
    """Write the shards whose rows changed below `folder`; the new {shard: path}.

    `placed` is the result of `reshard` for `docs`; `current` names the folders of the old shards. A shard that neither lost nor
    gained a row keeps its folder. A new generation gets a new folder, so readers of the old one are not disturbed and a
    failed run leaves it whole. Rows meet their places by id and text, and rows equal in both by their
    number among them, which no task counts alone.
    """
    moved = placed.where("old_shard <> shard")
    touched = {r[0] for r in moved.select("old_shard").union(moved.select("shard")).distinct().collect()}
    current = current or {}
    shards = [r[0] for r in placed.select("shard").distinct().collect()]
    write = sorted(s for s in shards if s in touched or s not in current)
    target = f"{folder.rstrip('/')}/generation-{uuid.uuid4().hex}"
    name, keys = "_shard", ["_id", "_text", "_crc"]
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    if write:
        places = placed.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text"), F.col("text_crc32").alias("_crc"), "shard", "slot")
        # all places are numbered, so that rows and places of one key get the same numbers
        places = ranked(places, keys, [F.col("shard"), F.col("slot")]).where(F.col("shard").isin(write))
        text = whole_text()
        rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_text"), F.crc32(text.cast("binary")).alias("_crc"),
                           F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_doc"), F.monotonically_increasing_id().alias("_nth"))
        rows = ranked(rows, keys, [F.col("_nth")])
        same = [rows[c].eqNullSafe(places[c]) for c in (*keys, "_rank")]
        joined = rows.join(places, same).select("_doc", "shard", "slot")
        joined = joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
        joined.select(*[F.col(f"_doc.{quoted(c)}") for c in docs.columns], F.col("shard").alias(name)).write.partitionBy(name).parquet(target)
    return {s: f"{target}/{name}={s}" if s in write else current[s] for s in shards}
