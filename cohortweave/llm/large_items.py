"""Best-fit packing with large-item matching.

Of documents above one third of the capacity at most two fit a sequence: the longest is matched with the longest other that fits
beside it. Smaller documents, longest first, go where the least room is left that holds them.

Only lengths decide, and there are no more of them than `capacity`. So the whole table is packed as one: the lengths' counts, at most
`capacity` rows, give a plan in terms of groups of sequences that are alike, and a document finds its sequence by its rank among
those of its length. Each length splits at most one group in two and opens at most two, and filling a group at least halves
its room, so the plan has at most 3 * capacity groups and 12 times as many lines, whatever the table holds.

Texts are tokenized where they are read; ranks come from range-partitioned rows without texts, so a length that a third of all documents
share is spread like any other.

Defined results: a null text is empty and has the closing id alone; rows repeated under a doc_id, or without one, are
documents of their own; documents above the capacity are cut into whole sequences and a rest; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.packing import words_of
from cohortweave.llm.shared import ranked
from cohortweave.runtime import settle

CAPACITY = 2048
CLOSING_ID = 0
PROBES = ("It's 12,5 o'clock: RUN! (now) a_b-c", "Éa naïve ß ÀÉ x2y 3,000.50 ...", "日本 語 áb  https://a.b/c?d=1&e")


class Line(NamedTuple):
    """Documents of `length` from rank `rank` on: `each` of them in each sequence from `sequence` on, at `offset`."""

    length: int
    rank: int
    each: int
    sequence: int
    offset: int


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Line], int]:
    """The lines for `counts` (documents by length), and the number of sequences."""
    left = {n: k for n, k in counts.items() if k}
    rank, lines, rooms, opened = dict.fromkeys(left, 0), [], [], 0

    def put(length: int, n: int, each: int, sequence: int, offset: int) -> None:
        lines.append(Line(length, rank[length], each, sequence, offset))
        rank[length] += n

    def opening(n: int, room: int) -> int:
        nonlocal opened
        if room:
            insort(rooms, (room, opened, n))
        opened += n
        return opened - n

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for place, length in enumerate(large):
        for partner in large[place:]:
            if not left[length] or length + partner > capacity:
                continue
            pairs = left[length] // 2 if partner == length else min(left[length], left[partner])
            if pairs:
                first = opening(pairs, capacity - length - partner)
                put(length, pairs * (1 + (partner == length)), 1 + (partner == length), first, 0)
                if partner != length:
                    put(partner, pairs, 1, first, length)
                left[length] -= pairs
                left[partner] -= pairs
        if left[length]:
            put(length, left[length], 1, opening(left[length], capacity - length), 0)
            left[length] = 0

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        waiting = left[length]
        while waiting:
            at = bisect_left(rooms, (length,))
            if at < len(rooms):
                room, sequence, n = rooms.pop(at)
            else:
                room, n = capacity, -(-waiting // (capacity // length))
                sequence, opened = opened, opened + n
            each = room // length
            full = min(n, waiting // each)
            rest = min(waiting - full * each, each) if full < n else 0
            for some, every, first in ((full, each, sequence), (1 if rest else 0, rest, sequence + full)):
                if some:
                    put(length, some * every, every, first, capacity - room)
                    if room > every * length:
                        insort(rooms, (room - every * length, first, some))
            used = full + (rest > 0)
            if used < n:
                insort(rooms, (room, sequence + used, n - used))
            waiting -= full * each + rest
    return lines, opened


def checked_words(path: str):
    """The word table, if the tokenizer is one whose ids of a text are those of its words."""
    known = words_of(path)
    if not getattr(known, "checked", False):
        for text in PROBES:
            ids = np.frombuffer(b"".join(known[w] for w in text.split(" ")), "<u4").tolist()
            if ids != known.tokenizer.encode(text, add_special_tokens=False).ids:
                raise ValueError(f"{path} does not tokenize word by word")
        known.checked = True
    return known


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, row) of every document."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "row"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    closing = np.array([CLOSING_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = checked_words(tokenizer_path)
        for batch in batches:
            out = []
            for doc_id, text, row in zip(*(c.to_pylist() for c in batch.columns)):
                ids = b"".join(map(known.__getitem__, (text or "").replace("\n", " ").split(" "))) + closing
                for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                    own = ids[4 * start:4 * (start + capacity)]
                    out.append((doc_id, piece, start, len(own) // 4, zlib.crc32(own), row))
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, row long")


def placed(pieces: DataFrame, lines: list[Line]) -> DataFrame:
    """`pieces` (with `_rank` among those of their length) with sequence_id and offset."""
    lines = sorted(lines)
    length, rank, each, sequence, offset = (np.array(c, np.int64) for c in zip(*lines)) if lines else [np.empty(0, np.int64)] * 5
    starts = length << 48 | rank
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, own = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(starts, size << 48 | own, "right") - 1
            turn, place = np.divmod(own - rank[at], each[at])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence[at] + turn), pa.array(offset[at] + place * size)],
                                             names=[*kept, "sequence_id", "offset"])

    return pieces.select(*kept, "_rank").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    pieces = settle(token_pieces(docs, tokenizer_path, capacity))  # range partitioning reads its input twice
    found = settle(ranked(pieces, ["length"], [F.col("row"), F.col("piece")]))
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    return placed(found, packing_plan(counts, capacity)[0])
