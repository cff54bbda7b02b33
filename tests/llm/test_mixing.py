import re
from collections import defaultdict

import pytest

from cohortweave.llm import mixing
from cohortweave.llm.queries import ORACLES, QUERIES


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left, free = total - sum(fixed.values()), [s for s in names if s not in fixed]
        level = left / sum(w[s] for s in free) if free else 0
        above = [s for s in free if level * w[s] > most * sizes[s]]
        if not above:
            return fixed | {s: level * w[s] for s in free}
        fixed |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 3}, {"a": 0, None: 5}, {"x": 7}, {"a": 1, "b": 1, "c": 1, "d": 10_000, None: 2}, {"a": 0}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_schedule_keeps_every_prefix_near_the_shares(spark):
    targets = spark.createDataFrame([("a", 4000, 6000.0), ("b", 5000, 2500.0), (None, 1000, 1500.0)], "source string, source_size long, target double")
    slots = sorted(mixing.schedule(targets, 4, chunk=16).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in slots] == list(range(2500))
    seen = defaultdict(int)
    for i, r in enumerate(slots, 1):
        assert r["block"] == seen[r["source"]]  # blocks in order, none left out
        seen[r["source"]] += 1
        for s, share in (("a", 0.6), ("b", 0.25), (None, 0.15)):
            assert abs(seen[s] - share * i) < 5


def test_taken_words_of_small_tables(docs_of):
    rows = [(i, "w " * (i % 40), "big") for i in range(200)] + [(300 + i, "v " * 9, None) for i in range(20)] + [(400, None, "none"), (401, "", "big"), (7, "w " * 7, "big")]
    got = mixing.taken_words(docs_of(rows, extra="taken"), block=8).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    by = defaultdict(lambda: [0, 0.0])
    source = {r["doc_id"]: r["source_size"] for r in got}
    for r in got:
        by[r["source_size"]][0] += r["taken"]
        by[r["source_size"]][1] = r["target"]
    assert all(abs(n - t) <= 4 * 8 for n, t in by.values()) and source[400] == 0
    assert mixing.taken_words(docs_of(["x"]).where("false")).count() == 0


def test_mixed_documents_hold_the_taken_words(docs_of):
    rows = [(i, f"  w{i}a w{i}b\tw{i}c \n w{i}d " * 5, "s%d" % (i % 3)) for i in range(60)] + [(99, None, "s0")]
    docs = docs_of(rows, extra="row")
    out = mixing.mixed_documents(docs, block=8)
    assert out.columns == docs.columns
    out = out.collect()
    texts = dict((i, t) for i, t, _ in rows)
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken_words(docs, block=8).collect()}
    counted = defaultdict(int)
    for r in out:
        n = len(re.findall(mixing.WORD, r["text"]))
        counted[r["doc_id"]] += n
        assert texts[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"]) and n
    assert {i: n for i, n in taken.items() if n} == dict(counted)


def test_very_long_text_is_cut(docs_of):
    out = mixing.mixed_documents(docs_of([(0, "ab " * 60_000, "a"), (1, "cd " * 60_000, "b")]), block=64).collect()
    assert {r["doc_id"] for r in out} == {0, 1}


def test_query_and_sql(spark, sf_dir):
    import duckdb

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = db.execute(ORACLES["op5_low_discrepancy_mix"])
    names = [d[0] for d in want.description]
    got = QUERIES["op5_low_discrepancy_mix"](spark, sf_dir)
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(want.fetchall())
