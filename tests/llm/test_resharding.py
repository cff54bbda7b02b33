import random
import zlib
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from cohortweave.llm import resharding
from cohortweave.llm.queries import QUERIES


def moved(flow):
    return sum(n for a, b, n in flow if a != b)


def test_flow_moves_as_little_as_can_be():
    for rows, shards in [({0: 10, 1: 0, 2: 2}, 3), ({0: 7, 5: 3}, 4), ({3: 100}, 7), ({}, 3), ({0: 5, 1: 5}, 2), ({0: 1, 1: 2, 2: 4}, 2)]:
        flow = resharding.transfers(rows, shards)
        out, new = Counter(), Counter({s: 0 for s in range(shards)})
        for a, b, n in flow:
            out[a] += n
            new[b] += n
        total = sum(rows.values())
        assert {a: n for a, n in rows.items() if n} == dict(out) and max(new.values()) - min(new.values()) <= 1
        least, more = divmod(total, shards)
        stay, above = 0, 0
        for s in range(shards):
            stay += min(rows.get(s, 0), least)
            above += rows.get(s, 0) > least
        assert moved(flow) == total - stay - min(above, more)


def test_rows_law_slots_and_smallest_documents_move(docs_of):
    docs = docs_of([(i, "x" * (i % 17), "s") for i in range(50)] + [(90, None, None), (91, "", "s"), (91, "", "s")])
    got = resharding.reshard(docs, F.lit(2), 5).collect()
    assert len(got) == 53
    counts = Counter(r["shard"] for r in got)
    assert sorted(counts.values()) == [10, 10, 11, 11, 11]
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    assert min(r["size"] for r in got if r["shard"] == 2) >= max(r["size"] for r in got if r["shard"] != 2)
    assert next(r for r in got if r["doc_id"] == 90)["size"] == 8
    assert resharding.reshard(docs.where("false"), F.lit(0), 4).count() == 0


def test_only_changed_shards_are_written(spark, docs_of, tmp_path):
    docs = docs_of([(i, f"text {i}", "s") for i in range(12)])
    old = F.when(F.col("doc_id") < 4, 0).when(F.col("doc_id") < 8, 1).when(F.col("doc_id") < 11, 2).otherwise(3)
    placed = resharding.reshard(docs, old, 3)
    paths = resharding.rewrite(docs, placed, str(tmp_path), {0: "old/0", 1: "old/1", 2: "old/2"})
    assert paths[0] == "old/0" and paths[1] == "old/1" and paths[2].startswith(str(tmp_path))
    assert {r["doc_id"] for r in spark.read.parquet(paths[2]).collect()} == {8, 9, 10, 11}


def test_query(spark, sf_dir):
    rows = QUERIES["op3_min_cost_flow_resharding"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts.items()}
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    old = Counter(r["old_shard"] for r in rows)
    stayed = sum(r["old_shard"] == r["shard"] for r in rows)
    least, more = divmod(len(rows), 24)
    assert stayed == sum(min(n, least) for n in old.values()) + min(more, sum(n > least for n in old.values()))


def fewest_bytes(sizes, shards):
    """By trying every choice of shards with the surplus row; each gives its smallest documents away."""
    total = sum(map(len, sizes.values()))
    least, more = divmod(total, shards)
    best = None
    for above in combinations(range(shards), more):
        bytes_moved = 0
        for shard, held in sizes.items():
            stay = least + (shard in above) if shard < shards else 0
            bytes_moved += sum(sorted(held, reverse=True)[stay:])
        best = bytes_moved if best is None else min(best, bytes_moved)
    return best


def test_fewest_bytes_move(docs_of):
    random.seed(3)
    cases = [({0: [1000] * 4, 1: [1] * 3}, 3), ({0: [1] * 4, 1: [1000] * 3}, 3), ({0: [5, 5], 1: [9], 4: [7, 1, 3]}, 2)]
    cases += [({s: [random.choice((0, 3, 40, 900)) for _ in range(random.randrange(1, 9))] for s in range(random.randrange(1, 5))}, random.randrange(2, 5))
              for _ in range(5)]
    for lengths, shards in cases:
        held = [(s, n) for s, ns in lengths.items() for n in ns]
        docs = docs_of([(i, "x" * n, str(s)) for i, (s, n) in enumerate(held)])
        got = resharding.reshard(docs, F.col("source").cast("int"), shards).collect()
        counts = Counter({s: 0 for s in range(shards)}) + Counter(r["shard"] for r in got)
        assert len(got) == len(held) and max(counts.values()) - min(counts[s] for s in range(shards)) <= 1
        sizes = {s: [n + 8 for n in ns] for s, ns in lengths.items()}
        assert sum(r["size"] for r in got if r["shard"] != r["old_shard"]) == fewest_bytes(sizes, shards), (lengths, shards)


def test_rewrite_keeps_each_row_once(spark, docs_of, tmp_path):
    rows = [(7, "same", "a"), (7, "same", "b"), (7, "other", "c"), (None, None, "d"), (None, "", "e"), (None, "", "f"), (None, "x", "g"), (1, "y", "h"), (2, "z", "i")]
    docs = docs_of(rows).withColumn("_shard", F.col("source")).withColumn("a.b", F.lit(3)).withColumn("_doc", F.lit(4)).withColumn("slot", F.lit(5))
    placed = resharding.reshard(docs, F.lit(0), 4)
    paths = resharding.rewrite(docs, placed, str(tmp_path))
    back = [r for s in paths for r in spark.read.parquet(paths[s]).collect()]
    assert sorted(r["source"] for r in back) == list("abcdefghi")
    assert all(r["_shard"] == r["source"] and (r["a.b"], r["_doc"], r["slot"]) == (3, 4, 5) for r in back)
    assert {r["source"]: (r["doc_id"], r["text"]) for r in back} == {c: (i, t) for i, t, c in rows}
    assert {s: spark.read.parquet(paths[s]).count() for s in paths} == Counter(r["shard"] for r in placed.collect())
