"""Document fingerprints by winnowing.

Every window of `window` consecutive k-gram hashes of a text's UTF-8 bytes gives its smallest hash, the rightmost of equal ones, with
its position. So two texts that share `window + k - 1` bytes share a selected hash, at positions that differ
by the shift between them; nothing shorter than k bytes ever matches. A text with fewer k-grams than a window is one
window; a text shorter than k is one gram.

`neighbours` brings each document together with the next by doc_id without one task over all: documents are dealt to ranges of
(doc_id, hash of the text), a partition each and as many as the bytes ask for, and the first document of each range goes to the range before
it as well. Many rows under one doc_id, also a null one, are split by the hash.

Defined results: a null text counts as empty; an empty text has no hashes, and two such are alike (1.0); rows repeated under
a doc_id follow each other in the order of a hash of the text; a null doc_id comes first; a single document
is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import hashlib
import json
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.shared import whole_text

BASE = 0x9E3779B97F4A7C15
LOWEST = -(1 << 63)
RANGE_BYTES = 256 << 20


def gram_hashes(data: bytes, k: int) -> np.ndarray:
    """Hash of every k-gram: a polynomial modulo 2^64 rolled over the text, then mixed."""
    values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(values) - k + 1
    if n < 1:
        return np.array([xxhash.xxh64_intdigest(data)], np.uint64) if data else np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    size, at, left = 1, 0, k  # k-grams put together from grams of 1, 2, 4, ... bytes
    power, part = np.uint64(BASE), values
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                h = h * power + part[at:at + n]
                at += size
            left >>= 1
            if left:
                part = part[:-size] * power + part[size:]
                power, size = power * power, size * 2
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ h >> np.uint64(32)


def winnow(text: str | None, k: int = 16, window: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, byte positions) selected from a text, in order."""
    h = gram_hashes((text or "").encode("utf-8"), k)
    if not len(h):
        return h, np.empty(0, np.int64)
    width = min(window, len(h))
    at = np.arange(len(h) - width + 1)
    low, place, size = h, np.arange(len(h)), 1
    while size < width:  # minimum over 1, 2, 4, ... positions, the right one of equals
        step = min(size, width - size)
        a, b = low[:-step], low[step:]
        right = b <= a
        low, place = np.where(right, b, a), np.where(right, place[step:], place[:-step])
        size += step
    place = np.unique(place[:len(at)])
    return h[place], place


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes over those of the larger set; two empty ones are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(len(a), len(b))


def written(hashes: np.ndarray, places: np.ndarray) -> str:
    """The fingerprint in short: how many hashes, and a digest of them with their positions."""
    return f"{len(hashes)}:{xxhash.xxh3_128_hexdigest(hashes.astype('<u8').tobytes() + places.astype('<i8').tobytes())}"


def edited(text: str, other: str) -> str:
    """`text` with its last quarter replaced by the first code points of `other`."""
    q = len(text) // 4
    return text[:len(text) - q] + other[:q] if q else text


def range_count(docs: DataFrame) -> int:
    """Ranges of about `RANGE_BYTES` of text, and no fewer than the session's shuffle partitions."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))


def range_starts(rows: DataFrame, ranges: int) -> list[tuple[int, int]]:
    """Sorted (id, hash) at which ranges of near equal counts begin; an id that fills several is split evenly by hash."""
    if ranges < 2:
        return []
    error = max(1e-5, min(0.01, 0.25 / ranges))
    cuts = rows.select(F.col("_id").cast("double").alias("d")).approxQuantile("d", [i / ranges for i in range(1, ranges)], error)
    often = Counter(min(int(c), -LOWEST - 1) for c in cuts)
    return [(i, LOWEST + (j << 64) // n) for i, n in sorted(often.items()) for j in range(n)]


def range_of(starts: list[tuple[int, int]]) -> Column:
    """How many of `starts` are at or before the row's (_id, _hash), by halving steps."""
    if not starts:
        return F.lit(0)
    bounds = F.from_json(F.lit(json.dumps([{"i": i, "h": h} for i, h in starts])), "array<struct<i bigint, h bigint>>")
    row = F.struct(F.col("_id").alias("i"), F.col("_hash").alias("h"))
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(starts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= row, at + step).otherwise(at))


def neighbours(docs: DataFrame, ranges: int) -> DataFrame:
    """(part, tail, doc_id, text): a sorted run a partition; `tail` rows only show what follows the last document of a part."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = rows.withColumn("_id", F.coalesce("doc_id", F.lit(LOWEST))).withColumn("_hash", F.xxhash64("text"))
    starts = range_starts(rows, ranges)
    rows = rows.withColumn("part", range_of(starts))
    # one row per range, as many as there are partitions
    firsts = sorted(tuple(r) for r in rows.groupBy("part").agg(F.min(F.struct("_id", "_hash")).alias("f")).select("part", "f._id", "f._hash").collect())
    before = {f: firsts[i - 1][0] for i, f in enumerate(firsts)}  # the first one follows the last range
    shown = F.array()
    if firsts:
        spread = docs.sparkSession.createDataFrame([(p, i, h, before[p, i, h]) for p, i, h in firsts], "part int, _id long, _hash long, _before int")
        rows = rows.join(F.broadcast(spread), ["part", "_id", "_hash"], "left")
        shown = F.when(F.col("_before").isNull(), F.array(F.struct("part", F.lit(False).alias("tail")))).otherwise(
            F.array(F.struct("part", F.lit(False).alias("tail")), F.struct(F.col("_before").alias("part"), F.lit(True).alias("tail"))))
    else:
        shown = F.array(F.struct("part", F.lit(False).alias("tail")))
    rows = rows.withColumn("_to", F.explode(shown)).select("_to.part", "_to.tail", "doc_id", "_id", "_hash", "text")
    return rows.repartitionById(len(starts) + 1, "part").sortWithinPartitions("part", "tail", "_id", "_hash").select("part", "tail", "doc_id", "text")


def fingerprint_edits(docs: DataFrame, k: int = 16, window: int = 24) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how near they and the next document's are."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (part, doc_id, text, hashes, places) that waits for the next document
        for batch in batches:
            out = []
            for part, tail, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if tail and (last is None or last[0] != part):
                    continue  # a repeated first row, already shown
                own = winnow(text, k, window)
                if last is not None:
                    text0, (h0, p0) = last[2], last[3]
                    changed = edited(text0, text)
                    h1, p1 = (h0, p0) if changed == text0 else winnow(changed, k, window)
                    out.append((last[1], len(text0), hashlib.sha256(changed.encode("utf-8")).hexdigest(), written(h0, p0), written(h1, p1),
                                likeness(h0, h1), likeness(h0, own[0])))
                last = None if tail else (part, doc_id, text, own)
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return neighbours(docs, range_count(docs)).mapInArrow(run, schema)


def fingerprints(docs: DataFrame, k: int = 16, window: int = 24) -> DataFrame:
    """(doc_id, hashes array<struct<hash, position>>): the selected hashes of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("hash", pa.int64()), ("position", pa.int64())]))
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                h, p = winnow(text, k, window)
                rows.append([{"hash": x, "position": y} for x, y in zip(h.view(np.int64).tolist(), p.tolist())])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "hashes"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, hashes array<struct<hash: long, position: long>>")
