import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortweave.llm import winnowing
from cohortweave.llm.queries import QUERIES


def plain_winnow(data, k, window):
    h = winnowing.gram_hashes(data, k).tolist()
    if not h:
        return []
    width, chosen = min(window, len(h)), []
    for i in range(len(h) - width + 1):
        part = h[i:i + width]
        low = min(part)
        place = i + max(j for j, x in enumerate(part) if x == low)
        if not chosen or chosen[-1] != place:
            chosen.append(place)
    return chosen


@pytest.mark.parametrize("text", ["", "a", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "äöü" * 40, "ab" * 60 + "c" * 70])
@pytest.mark.parametrize("k, window", [(5, 4), (16, 24), (7, 1)])
def test_rightmost_minimum_of_every_window(text, k, window):
    _, places = winnowing.winnow(text, k, window)
    assert places.tolist() == plain_winnow(text.encode(), k, window)


def test_gram_hashes_depend_on_the_gram_alone():
    rng = random.Random(4)
    data = bytes(rng.choice(b"abc") for _ in range(400))
    for k in (1, 3, 16):
        h, seen = winnowing.gram_hashes(data, k), {}
        for i in range(len(data) - k + 1):
            assert seen.setdefault(data[i:i + k], int(h[i])) == int(h[i])
        assert len(set(seen.values())) == len(seen)


def test_shared_passage_is_always_found():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    for _ in range(50):
        shared = word(24 + 16 - 1)
        a, b = word(rng.randrange(300)) + shared + word(90), word(rng.randrange(300)) + shared + word(40)
        (ha, pa), (hb, pb) = winnowing.winnow(a), winnowing.winnow(b)
        both = set(ha.tolist()) & set(hb.tolist())
        assert both
        shift = a.index(shared) - b.index(shared)
        assert any(int(pa[list(ha).index(h)]) - int(pb[list(hb).index(h)]) == shift for h in np.array(sorted(both), np.uint64))


def expected(rows):
    rows = sorted(rows, key=lambda r: r[0])
    out = {}
    for i, (doc_id, text) in enumerate(rows):
        follower = rows[(i + 1) % len(rows)][1]
        q = len(text) // 4
        changed = text[:len(text) - q] + follower[:q]
        h0, h1, h2 = (winnowing.winnow(t)[0] for t in (text, changed, follower))
        out[doc_id] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), winnowing.likeness(h0, h1), winnowing.likeness(h0, h2))
    return out


def shown(df):
    return {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in df.collect()}


def test_edits_take_the_next_document_also_over_ranges(docs_of):
    rng = random.Random(6)
    texts = ["".join(rng.choice("xyzäß€😀 ") for _ in range(rng.choice([0, 1, 3, 4, 30, 300]))) for _ in range(60)]
    rows = [(i * 7, t) for i, t in enumerate(texts)]
    got = winnowing.fingerprint_edits(docs_of([(i, t, None) for i, t in rows]))
    assert shown(got) == expected(rows)


def test_odd_tables(docs_of):
    assert shown(winnowing.fingerprint_edits(docs_of([None]))) == expected([(0, "")])
    twice = winnowing.fingerprint_edits(docs_of([(1, "same text here", "s")] * 4 + [(None, "first", "s")])).collect()
    assert len(twice) == 5 and len({r["fingerprint"] for r in twice if r["doc_id"] == 1}) == 1
    assert winnowing.fingerprint_edits(docs_of(["x"]).where("false")).count() == 0
    assert winnowing.fingerprints(docs_of(["some text that is long enough", None])).count() == 2


def test_many_rows_under_one_id_are_split(docs_of):
    """A third of the rows without an id, a third under one id: still ranges of near equal counts, and the same results."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh ") for _ in range(40))
    table = docs_of([(i if i % 3 == 2 else 50 if i % 3 else None, word(), "s") for i in range(600)])
    parts = winnowing.neighbours(table, 12).where("NOT tail").withColumn("at", F.spark_partition_id())
    sizes = [r["count"] for r in parts.groupBy("part", "at").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 150 and sum(sizes) == 600
    rows = [(n, r["text"]) for n, r in enumerate(table.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect())]
    got = winnowing.fingerprint_edits(table).select("n_chars", "edited_sha256", "near_edited", "near_next").collect()
    assert sorted(map(tuple, got)) == sorted(expected(rows).values())


def test_ranges_begin_where_asked(spark):
    low, high = winnowing.LOWEST, -winnowing.LOWEST - 1
    starts = [(low, 0), (1, low), (1, 0), (7, low), (high, low)]
    rows = spark.createDataFrame([(i, h) for i in (low, 0, 1, 6, 7, high) for h in (low, -1, 0, high)], "_id long, _hash long")
    for n in range(len(starts) + 1):
        for r in rows.withColumn("part", winnowing.range_of(starts[:n])).collect():
            assert r["part"] == sum(s <= (r["_id"], r["_hash"]) for s in starts[:n])


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = shown(QUERIES["op2_winnowing"](spark, sf_dir))
    assert got == expected([(r["doc_id"], r["text"] or "") for r in docs.collect()])
    assert sum(v[2] for v in got.values()) / len(got) > 0.6
