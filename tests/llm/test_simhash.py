import random

import numpy as np
import xxhash

from cohortweave.llm import simhash
from cohortweave.llm.queries import QUERIES
from cohortweave.llm.shared import components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance):
    ids = sorted(prints)
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and bin(prints[i] ^ prints[j]).count("1") <= distance:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i in ids}


def test_fingerprint_by_hand():
    for text in ["", None, "a", "A b\tc", "One two x three\x0bfour FIVE six", "Ärger ÄRGER straße x y z", "w " * 50]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def near_copies(seed):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(60)] for _ in range(6)]
    texts = [None, "", "", "solo", "Solo"]
    for words in base:
        for _ in range(15):
            copy = list(words)
            if rng.random() < 0.8:
                copy[rng.randrange(60)] = "edit" + str(rng.randrange(99))
            texts.append(" ".join(copy))
    return texts


def test_groups_equal_brute_force_also_when_buckets_are_crowded(docs_of):
    texts = near_copies(3)
    docs = docs_of(texts)
    expected = plain_groups({i: plain_fingerprint(t) for i, t in enumerate(texts)}, 4)
    assert len(set(expected.values())) < len(texts) - 20
    for large in (20_000, 2):
        got = {r["doc_id"]: r["component_id"] for r in simhash.simhash_groups(docs, large=large).collect()}
        assert got == expected


def test_random_links_of_the_index(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flipped = base.copy()
    for i in range(len(base)):
        for b in rng.choice(64, 4, replace=False):
            flipped[i] ^= np.uint64(1 << int(b))
    rows = [(int(x),) for x in np.concatenate((base, flipped)).view(np.int64)]
    prints = spark.createDataFrame(rows, "fp long")
    roots = components(simhash.bucket_links(simhash.index_rows(prints), 4)).collect()
    assert len(roots) == 80 and len({r["root"] for r in roots}) == 40


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(300)] + [(5, 5), (7, 6)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    by_root = {}
    for r in got:
        by_root.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(len, by_root.values())) == [301, 301]


def test_one_row_of_each_group_stays(docs_of):
    docs = docs_of([(5, "a b c d e f", "s"), (3, "a b c d e f", None), (9, "x y z q w e r t", "s"), (9, "x y z q w e r t", "s"), (None, "lone m n o p", "s")])
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect() if r["doc_id"] is not None) == [(False, 3), (False, 9)]
    assert kept.where("doc_id IS NULL").count() == 1
    assert simhash.one_per_group(docs.where("false")).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = QUERIES["op1_simhash_deletion_variants"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == plain_groups(prints, 4)
