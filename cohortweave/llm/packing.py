"""Packing token sequences by minimum bin slack.

A document's ids are cut into full windows of `capacity` and a remainder. Full windows are sequences of their own;
remainders are filled together: each window takes the longest remainder left and the multiset of other lengths that
comes closest to the room beside it. The multiset is found by subset-sum over bitsets (bit n: length n can be
reached), with counts in powers of two, and read back from the kept bitsets.

Only lengths meet in a group, never ids: texts are tokenized where they are read, and the checksums of the pieces are made there.
Groups are dealt by a hash of the row and hold about `group` remainders each, however documents, sources or copies are
distributed; each leaves one open window or two.

Defined results: a null text is empty and has the closing id alone; rows repeated under a doc_id are
packed as documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.runtime import settle

CAPACITY = 2048
CLOSING_ID = 1


def fill(lengths: Counter, room: int) -> dict[int, int]:
    """How many of each length fill `room` as far as can be; the longest lengths are tried first."""
    if room < 1:
        return {}
    reach, steps = 1, []
    everything = (1 << (room + 1)) - 1
    full = 1 << room
    for length in sorted((n for n in lengths if 0 < n <= room), reverse=True):
        left, unit = min(lengths[length], room // length), 1
        while left:
            take = min(unit, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & everything
            left, unit = left - take, unit * 2
        if reach & full:
            break
    at, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            used[length] = used.get(length, 0) + take
    return used


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Lengths of every window; each of `lengths` (at most `capacity`) is in exactly one."""
    left, windows = Counter(lengths), []
    while left:
        longest = max(left)
        window = [longest]
        left[longest] -= 1
        for length, n in fill(left, capacity - longest).items():
            window += [length] * n
            left[length] -= n
        left = +left
        windows.append(window)
    return windows


STOPS = frozenset(".,;:!?")


class Words(dict):
    """The ids (as bytes) of words without white space. The tokenizer never joins over white space, so a
    text's ids are its words' ids; a full table starts anew."""

    def __init__(self, tokenizer, most: int = 1_500_000):
        super().__init__()
        self.tokenizer, self.most = tokenizer, most

    def __missing__(self, word: str) -> bytes:
        # case does not count, and letters and the stop behind them are tokenized apart
        if word[-1:] in STOPS and word[:-1].isalpha() and word.isascii():
            return self[word[:-1]] + self[word[-1]]
        if word.isascii() and word.isalpha() and not word.islower():
            return self[word.lower()]
        ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def words_of(tokenizer_path: str) -> Words:
    """The words known in this worker process; they serve the tasks after this one too."""
    from tokenizers import Tokenizer

    return Words(Tokenizer.from_file(tokenizer_path))


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, row): the pieces of every document, without a sequence yet."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row long"
    closing = np.array([CLOSING_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words_of(tokenizer_path)
        for batch in batches:
            out = []
            for doc_id, text, row in zip(*(c.to_pylist() for c in batch.columns)):
                ids = b"".join(map(known.__getitem__, (text or "").replace("\n", " ").split(" "))) + closing
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    piece = ids[4 * start:4 * (start + capacity)]
                    out.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), n, row))
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in schema.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, group: int = 4096) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    pieces = settle(token_pieces(docs, tokenizer_path, capacity))
    groups = max(1, pieces.count() // group)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row", "start"]).reset_index(drop=True)
        waiting: dict[int, list[int]] = {}
        for place, n in enumerate(rows["length"].tolist()):
            waiting.setdefault(n, []).append(place)
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for number, window in enumerate(pack(rows["length"].tolist(), capacity)):
            at = 0
            for n in window:
                place = waiting[n].pop()
                sequence[place], offset[place] = (key[0] << 32) + number, at
                at += n
        out = rows.drop(columns=["row", "group"])
        return out.assign(sequence_id=sequence, offset=offset)

    # every group is packed alike whether its pieces are full windows or remainders
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row", "start"), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(run, schema)
