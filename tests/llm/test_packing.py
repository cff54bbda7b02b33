import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

from cohortweave.llm import packing
from cohortweave.llm.queries import QUERIES, tokenizer_path


def test_fill_comes_as_near_as_can_be():
    rng = random.Random(2)
    for _ in range(200):
        items = [rng.randrange(1, 40) for _ in range(rng.randrange(0, 9))]
        room = rng.randrange(0, 90)
        used = packing.fill(Counter(items), room)
        best = max(sum(c) for n in range(len(items) + 1) for c in combinations(items, n) if sum(c) <= room)
        assert sum(k * n for k, n in used.items()) == best
        assert all(n <= items.count(k) for k, n in used.items())


def test_every_length_is_packed_once():
    rng = random.Random(3)
    lengths = [rng.randrange(1, 2049) for _ in range(500)] + [2048] * 5 + [1] * 30
    windows = packing.pack(lengths)
    assert Counter(n for w in windows for n in w) == Counter(lengths)
    assert all(sum(w) <= 2048 for w in windows)
    assert len(windows) <= sum(lengths) / 2048 * 1.05 + 2


def encode(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def check(rows, texts):
    ids = {i: e for i, e in zip(texts, encode(texts.values()))}
    of, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        of[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
        piece = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert r["ids_crc32"] == zlib.crc32(piece) and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert set(of) == set(texts)
    for i, pieces in of.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0
            at += p["length"]
        assert at == len(ids[i])
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    return sum(len(e) for e in ids.values()), len(sequences)


def test_odd_texts(docs_of):
    texts = {0: None, 1: "", 2: "  \n\t ", 3: "word " * 9000, 4: "x" * 3000, 5: "It's <|endoftext|> NOW and then é ́ É ﬁ 12345 ¡$$$!",
             6: "Σίσυφος ΣΊΣΥΦΟΣ İstanbul", 7: "don't\nwe'll 've", 8: "tab\tbed\r\nline"}
    rows = packing.pack_documents(docs_of([(i, t, "s") for i, t in texts.items()], extra="group"), tokenizer_path(), group=4).collect()
    check(rows, texts)
    assert packing.pack_documents(docs_of(["x"]).where("false"), tokenizer_path()).count() == 0
    twice = packing.pack_documents(docs_of([(1, "a b", "s"), (1, "a b", "s")]), tokenizer_path()).collect()
    assert len(twice) == 2 and {r["offset"] for r in twice} == {0, 3}


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    total, sequences = check(QUERIES["op9_min_bin_slack_packing"](spark, sf_dir).collect(), texts)
    assert sequences * 2048 < total * 1.02 + 2 * 2048
