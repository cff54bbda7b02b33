"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits link at `distance` or fewer differing bits. They are cut into three segments:
of four differing bits some segment has at most one. Each segment is indexed under every variant with
one bit wildcarded (64 index rows in all), so two segments meet in an equality on a variant exactly
when they differ in at most one bit; the whole distance is then verified.

* Copies count once: only distinct fingerprints are indexed.
* Of the verified links of a bucket only a spanning forest leaves the task, never all pairs.
* A bucket with more than `large` fingerprints is not compared pair by pair. Two fingerprints are within
  four bits exactly when some value is within two bits of both, so each member is sent to the 2081 values
  within two bits of it, and those who meet are linked to the smallest: linear in the members, no
  group is collected, and it finds the same components.

Defined results: null text counts as empty; a text without words has fingerprint zero and is linked
like any other; rows repeated under a doc_id keep one row each and share a component; a null doc_id
takes part and never names a component unless alone; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.shared import components, row_key
from cohortweave.runtime import Scope, quoted, settle

SEED = 42
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # lowest bit, width
BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, words: int = 4) -> int:
    """Bit i is set when more than half of the shingles' XXH64 values have it set; repeats count."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII only, as bytes
    if not tokens:
        return 0
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    n = len(tokens) - words + 1
    hashes = np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends[words - 1:].tolist())), np.uint64, n)
    columns = hashes.view(np.uint8).reshape(n, 8)
    counts = np.concatenate([np.bincount(columns[:, i], minlength=256) @ BYTE_BITS for i in range(8)])
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 4, key: str = "doc_id", kind: str = "long") -> DataFrame:
    """The column `key` and `fp`, the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [key, "fp"])

    return docs.select(F.col(key).cast(kind), "text").mapInArrow(run, f"{key} {kind}, fp long")


def index_rows(prints: DataFrame) -> DataFrame:
    """(key, fp): 64 rows per fingerprint, one for each bit that is wildcarded in its segment."""
    keys = []
    for s, (low, width) in enumerate(SEGMENTS):
        segment = f"(shiftrightunsigned(fp, {low}) & {(1 << width) - 1}L)"
        keys += [f"{(s << 5 | bit) << 24}L | ({segment} & {((1 << width) - 1) & ~(1 << bit)}L)" for bit in range(width)]
    return prints.select("fp", F.explode(F.expr(f"array({', '.join(keys)})")).alias("key"))


class Forest:
    """Union-find over array places."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.up[x]
            if np.array_equal(up, x):
                return x
            x = up

    def join(self, a: int, b: int) -> bool:
        up = self.up
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        while up[b] != b:
            up[b] = up[up[b]]
            b = up[b]
        if a == b:
            return False
        up[max(a, b)] = min(a, b)
        return True


def forest_links(keys: np.ndarray, values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between values with equal (sorted) keys within `distance` bits, without those that close a circle."""
    ids, place = np.unique(values, return_inverse=True)
    forest, out, lag = Forest(len(ids)), [], 1
    at = np.flatnonzero(keys[:-1] == keys[1:])
    while len(at):
        a, b = place[at], place[at + lag]
        near = np.bitwise_count(values[at] ^ values[at + lag]) <= distance
        a, b = a[near], b[near]
        apart = forest.roots(a) != forest.roots(b)
        out += [(x, y) for x, y in zip(a[apart].tolist(), b[apart].tolist()) if forest.join(x, y)]
        lag += 1
        at = at[at + lag < len(keys)]
        at = at[keys[at] == keys[at + lag]]
    links = np.array(out, np.int64).reshape(-1, 2)
    return ids[links[:, 0]], ids[links[:, 1]]


def bucket_links(index: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) found within the buckets of `index`, as a forest per batch of whole buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.empty(0, np.int64), np.empty(0, np.uint64)

        def emit(k, v):
            a, b = forest_links(k, v, distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy()))
            values = np.concatenate((values, batch.column(1).to_numpy().view(np.uint64)))
            if len(keys):
                whole = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on in the next batch
                if whole:
                    yield emit(keys[:whole], values[:whole])
                keys, values = keys[whole:], values[whole:]
        if len(keys):
            yield emit(keys, values)

    dealt = index.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def centre_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links of `prints` (fp) through the values that lie within half the distance of each."""
    masks = {0}
    for _ in range(distance // 2):
        masks |= {m ^ (1 << i) for m in masks for i in range(64)}
    signed = sorted(m - (1 << 64) if m >> 63 else m for m in masks)
    centres = prints.select("fp", F.explode(F.from_json(F.lit(str(signed)), "array<bigint>")).alias("m"))
    centres = centres.select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("c"))
    first = centres.groupBy("c").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z")
    return centres.join(first, "c").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def rooted(prints: DataFrame, distance: int, large: int) -> DataFrame:
    """`prints` with `root`, one fingerprint for each component."""
    if distance not in (0, 2, 4):
        raise ValueError("three segments with one wildcard each serve distances of 0, 2 or 4 bits")
    with Scope() as scope:
        distinct = prints.select("fp").distinct()
        index = settle(index_rows(distinct))
        crowded = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > large).select("key")
        links = bucket_links(index.join(crowded, "key", "left_anti"), distance)
        links = links.union(centre_links(index.join(crowded, "key", "left_semi").select("fp").distinct(), distance))
        roots = components(links)
        scope.drop_but(roots)
    return prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_groups(docs: DataFrame, words: int = 4, distance: int = 4, large: int = 20_000) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable through links."""
    prints = settle(fingerprints(docs, words))
    # one row per distinct fingerprint carries the name; a fingerprint that many rows share meets one row only
    each = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    named = rooted(each, distance, large)
    smallest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    names = settle(named.join(smallest, "root").select("fp", "component_id"))
    return prints.join(names, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, words: int = 4, distance: int = 4, large: int = 20_000) -> DataFrame:
    """`docs` without the near copies: one row of each group stays, that of the smallest doc_id, then text hash; null ids come last.

    A row is told by its doc_id and text together, so rows of other groups with the same doc_id, or none, stay as well.
    """
    keyed = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("doc"), row_key().alias("_key"), "text")
    last = F.substring("_key", 1, 1) == F.unhex(F.lit("00"))  # no doc_id
    prints = fingerprints(keyed, words, "_key", "binary")
    each = settle(prints.groupBy("fp").agg(F.min(F.struct(last.alias("last"), "_key")).alias("low")))
    stays = rooted(each, distance, large).groupBy("root").agg(F.min("low")["_key"].alias("_key")).select("_key")
    return keyed.join(stays, "_key", "left_semi").dropDuplicates(["_key"]).select(*[F.col(f"doc.{quoted(c)}") for c in docs.columns])
