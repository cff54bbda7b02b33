"""Substring deduplication with suffix automata of reference shards.

A window of `window` consecutive words goes when its words also start earlier (smaller doc_id, or earlier in the same document); a word goes
when a window over it goes.

Each window has an anchor: the smallest hash of its `gram`-word grams, the leftmost of equal ones. Equal windows have equal anchors at
equal places, so a window can only repeat where its anchor does. Consecutive windows with one anchor form a piece. Pieces with equal anchors
meet in one reference shard: distinct pieces in corpus order run through the shard's suffix automaton, whose matching statistics
tell which windows occurred before, and are then added to it. Later copies of an equal piece go as a whole.

An automaton is not broadcast to all documents: every shard against every document would be quadratic in the corpus. It meets only the
pieces that share its anchor. An anchor with more than `crowd` occurrences (a common phrase in many contexts) is split: its
windows are dealt out by their own hash, which equal windows share, so no shard ever holds more than `crowd` distinct pieces,
and equal pieces are combined before they are shuffled.

Defined results: a null text has no words; fewer words than a window: nothing goes; rows with equal doc_id and text are one document
and are cleaned alike; other rows of a doc_id, also of a null one, are documents of their own; a null doc_id comes first; an empty table gives an empty result. Anchors are compared as 64-bit hashes, which can
only bring strangers together; equal pieces are told by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.shared import may_hold, row_key
from cohortweave.runtime import Scope, settle

BASE = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """XXH64 of words; a full table starts anew."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word, 3)
        if len(self) >= 500_000:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


def rolled(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` values, put together from runs of 1, 2, 4, ... of them."""
    n = len(values) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    h, at, width, power, part, left = np.zeros(n, np.uint64), 0, 1, BASE, values, size
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                h = h * power + part[at:at + n]
                at += width
            left >>= 1
            if left:
                part = part[:-width] * power + part[width:]
                power, width = power * power, width * 2
        h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ h >> np.uint64(29)


def word_pieces(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchors, first windows, numbers of windows) of the pieces of a document."""
    n = len(hashes) - window + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    low, width, size = rolled(hashes, gram), window - gram + 1, 1
    place = np.arange(len(low))
    while size < width:  # the smallest of 1, 2, 4, ... grams, the left one of equals
        step = min(size, width - size)
        left = low[:-step] <= low[step:]
        low, place = np.where(left, low[:-step], low[step:]), np.where(left, place[:-step], place[step:])
        size += step
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return low[first], first, np.diff(np.append(first, n))


class Automaton:
    """Suffix automaton over words."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.last, self.parts = [-1], [0], 0, 0

    def add(self, word) -> None:
        nxt, link, length = self.next, self.link, self.length
        new, p = len(nxt), self.last
        nxt.append({})
        link.append(0)
        length.append(length[p] + 1)
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(word) == q:
                    nxt[p][word] = copy
                    p = link[p]
                link[q] = link[new] = copy
        self.last = new

    def add_piece(self, words: list) -> None:
        for w in words:
            self.add(w)
        self.parts += 1
        self.add(self.parts)  # a number is no word: matches end here

    def statistics(self, words: list) -> list[int]:
        """For each word, how many words that end with it occur in the automaton."""
        state, matched, out = 0, 0, []
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if w in self.next[state]:
                state, matched = self.next[state][w], matched + 1
            out.append(matched)
        return out


def runs(flags: list[bool]) -> list[tuple[int, int]]:
    """[from, to) of each run of true values."""
    out, at = [], None
    for i, f in enumerate([*flags, False]):
        if f and at is None:
            at = i
        elif not f and at is not None:
            out.append((at, i))
            at = None
    return out


def anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, id), one row per piece. `docs`: id, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            found, counts = [np.empty(0, np.uint64)], []
            for text in batch.column(1).to_pylist():
                words = (text or "").encode("utf-8").split()
                found.append(word_pieces(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), window, gram)[0])
                counts.append(len(found[-1]))
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), ids], names=["anchor", "id"])

    return docs.select("id", "text").mapInArrow(run, "anchor long, id binary")


def cut_pieces(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, id, start, n, text) of the pieces with an anchor in `repeated` (map<anchor, split>). `docs`: id, text, repeated."""
    schema = "key long, id binary, start int, n int, text string"
    types = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            out = []
            for i, text, repeated in zip(*(c.to_pylist() for c in batch.columns)):
                repeated = dict(repeated)
                words = (text or "").encode("utf-8").split()
                hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                keys, first, count = word_pieces(hashes, window, gram)
                whole = None
                for key, at, n in zip(keys.view(np.int64).tolist(), first.tolist(), count.tolist()):
                    split = repeated.get(key)
                    if split:
                        if whole is None:
                            whole = rolled(hashes, window).view(np.int64)
                        out += [(int(whole[j]), i, j, 1, b" ".join(words[j:j + window]).decode()) for j in range(at, at + n)]
                    elif split is not None:
                        out.append((key, i, at, n, b" ".join(words[at:at + n + window - 1]).decode()))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["key", "id", "start", "n", "text"])

    return docs.select("id", "text", "repeated").mapInArrow(run, schema)


def match_pieces(distinct: DataFrame, window: int) -> DataFrame:
    """(id, low, high): words of first occurrences that windows of earlier pieces of the same shard cover.

    `distinct`: key, id, start, text; one row per distinct piece with the place where it occurs first.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, automaton = None, None, None
        for batch in batches:
            out = []
            for key, i, start, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.split(" ")
                if key != at:
                    at, waiting, automaton = key, words, None
                    continue
                if automaton is None:  # a shard with a single piece needs none
                    automaton = Automaton()
                    automaton.add_piece(waiting)
                found = [m >= window for m in automaton.statistics(words)][window - 1:]
                out += [(i, start + a, start + b + window - 1) for a, b in runs(found)]
                if not all(found):
                    automaton.add_piece(words)
            columns = list(zip(*out)) or [[]] * 3
            types = [pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["id", "low", "high"])

    dealt = distinct.repartition("key").sortWithinPartitions("key", "id", "start").select("key", "id", "start", "text")
    return dealt.mapInArrow(run, "id binary, low long, high long")


def repeated_words(docs: DataFrame, window: int = 20, gram: int = 8, crowd: int = 1000) -> DataFrame:
    """(id, gone): word ranges [low, high) to be removed of every document that has some. `docs`: id, text."""
    with Scope() as scope:
        found = settle(anchors(docs, window, gram))
        often = settle(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", (F.col("n") > crowd).alias("split")))
        # a hot anchor counts once in a document, which is settled before the anchors meet
        own = found.where(may_hold(often.select("anchor"), F.col("anchor"), 1 << 23)).distinct().join(often, "anchor")
        own = settle(own.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("anchor", "split"))).alias("repeated")))
        scope.drop(found, often)
        some = docs.where(may_hold(own.select("id"), F.col("id"))).join(own, "id")
        pieces = settle(cut_pieces(some, window, gram).withColumn("t", F.xxhash64("text")))
        scope.drop(own)
        distinct = settle(pieces.groupBy("key", "t", "text").agg(F.min(F.struct("id", "start")).alias("first"), F.count(F.lit(1)).alias("times")))
        partly = match_pieces(distinct.select("key", "first.id", "first.start", "text"), window)
        copied = settle(distinct.where("times > 1").select("key", "t", "first"))
        copies = pieces.select("key", "t", "id", "start", "n").where(may_hold(copied.select("t"), F.col("t"), 1 << 23)).join(copied, ["key", "t"])
        wholly = copies.where((F.col("id") != F.col("first.id")) | (F.col("start") != F.col("first.start"))).select(
            "id", F.col("start").cast("long").alias("low"), (F.col("start") + F.col("n") + (window - 1)).cast("long").alias("high"))
        gone = settle(partly.union(wholly).groupBy("id").agg(F.array_sort(F.collect_set(F.struct("low", "high"))).alias("gone")))
        scope.drop_but(gone)
        return gone


def kept_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words of each text outside its ranges. `docs`: doc_id, text, gone."""
    schema = "doc_id long, n_words long, n_removed long, kept string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, text, gone in zip(*(c.to_pylist() for c in batch.columns)):
                words = (text or "").encode("utf-8").split()
                kept, at = [], 0
                for r in gone or ():
                    kept += words[at:max(at, r["low"])]
                    at = max(at, r["high"])
                kept += words[at:]
                out.append((i, len(words), len(words) - len(kept), b" ".join(kept).decode()))
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])],
                                             names=["doc_id", "n_words", "n_removed", "kept"])

    return docs.select("doc_id", "text", "gone").mapInArrow(run, schema)


def without_repeats(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("id"), "text")
    gone = repeated_words(rows.select("id", "text"), **settings)
    touched = may_hold(gone.select("id"), F.col("id"))
    kind = gone.schema["gone"].dataType
    left = rows.where(touched).join(gone, "id", "left").select("doc_id", "text", "gone")
    return kept_words(rows.where(~touched).select("doc_id", "text", F.lit(None).cast(kind).alias("gone"))).union(kept_words(left))
