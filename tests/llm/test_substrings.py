import hashlib
import random

import pytest

from cohortweave.llm import substrings
from cohortweave.llm.queries import QUERIES


def brute_force(docs, window=20):
    """{doc_id: (words, removed, kept text)}"""
    seen, out = set(), {}
    split = {i: (t or "").encode().split() for i, t in docs.items()}
    for i in sorted(split):
        words = split[i]
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            w = tuple(words[a:a + window])
            if w in seen:
                gone[a:a + window] = [True] * window
            seen.add(w)
        kept = [w for w, g in zip(words, gone) if not g]
        out[i] = len(words), len(words) - len(kept), b" ".join(kept).decode()
    return out


def shown(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(60))
    passages = [[word() for _ in range(rng.choice([19, 20, 21, 35, 120]))] for _ in range(8)] + [["x"] * 70, ["p", "q"] * 40, ["common"] + [word() for _ in range(11)]]
    docs = {}
    for i in range(120):
        words = []
        for _ in range(rng.randrange(6)):
            words += [word() for _ in range(rng.randrange(30))] + list(rng.choice(passages))
            if words and rng.random() < 0.3:
                words[rng.randrange(len(words))] = word()
        docs[i * 2] = rng.choice([" ", "\n", " \t"]).join(words)
    return docs | {1: None, 3: "", 5: "é " * 25, 7: "é " * 25 + "end", 9: "z" * 5000 + " tail"}


@pytest.mark.parametrize("crowd, gram", [(1000, 8), (3, 8), (1000, 20), (2, 1)])
def test_equals_brute_force(docs_of, crowd, gram):
    docs = corpus(21)
    got = substrings.without_repeats(docs_of([(i, t, "s") for i, t in docs.items()], extra="gone"), crowd=crowd, gram=gram)
    want = brute_force(docs)
    assert shown(got) == want and sum(w[1] for w in want.values()) > 500


def test_automaton_statistics():
    rng = random.Random(2)
    for _ in range(50):
        machine, pieces = substrings.Automaton(), []
        for _ in range(5):
            words = [rng.choice("abc") for _ in range(rng.randrange(1, 30))]
            text = ["".join(p) for p in pieces]
            want = []
            for e in range(len(words)):
                want.append(max(n for n in range(e + 2) if n == 0 or any("".join(words[e + 1 - n:e + 1]) in t for t in text)))
            assert machine.statistics(words) == want
            machine.add_piece(words)
            pieces.append(words)


def test_repeated_ids_and_empty_tables(docs_of):
    text = " ".join(f"w{i}" for i in range(30))
    got = substrings.without_repeats(docs_of([(4, text, "s"), (4, text, "s"), (None, text, "s")])).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in got) == [(-1, 0), (4, 30), (4, 30)]
    assert substrings.without_repeats(docs_of(["x"]).where("false")).count() == 0


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = {i: (n, r, hashlib.sha256(k.encode()).hexdigest()) for i, (n, r, k) in brute_force(texts).items()}
    rows = QUERIES["op8_suffix_automaton_dedup"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows} == want
