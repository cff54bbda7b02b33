import random
import zlib

import numpy as np

from cohortweave.llm import toxicity
from cohortweave.llm.queries import QUERIES


def test_ftrl_by_hand():
    s = toxicity.Settings(bits=4, alpha=0.5, beta=1.0, l1=0.1, l2=0.5)
    model, z, n = toxicity.Ftrl(s), np.zeros(16), np.zeros(16)
    bz = bn = 0.0
    rng = np.random.default_rng(1)
    for _ in range(100):
        places, y = np.unique(rng.integers(0, 16, 4)), int(rng.integers(0, 2))
        x = 1 / len(places) ** 0.25
        w = [0.0 if abs(z[i]) <= s.l1 else -(z[i] - np.sign(z[i]) * s.l1) / ((s.beta + n[i] ** 0.5) / s.alpha + s.l2) for i in places]
        b = -bz / ((s.beta + bn ** 0.5) / s.alpha)
        p = 1 / (1 + np.exp(-(b + x * sum(w))))
        for i, wi in zip(places, w):
            g = (p - y) * x
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / s.alpha * wi
            n[i] += g * g
        g = p - y
        bz += g - ((bn + g * g) ** 0.5 - bn ** 0.5) / s.alpha * b
        bn += g * g
        model.learn(places, y)
    assert np.allclose(model.z, z) and np.allclose(model.n, n) and np.isclose(model.bias_z, bz)


def corpus(n):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(rng.choice([5, 40, 300]))]
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["awful", "awfulness", "nasty"]))
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_learns_and_holds_out(spark, docs_of):
    rows, labels = corpus(600)
    table = spark.createDataFrame(labels + [(None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxic_scores(docs_of(rows + [(700, None, None), (701, "", "s")]), table).collect()}
    truth = {i: y for i, _, y in labels}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i in truth if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[700]["score"] == got[701]["score"]
    kept = toxicity.without_toxic(docs_of(rows), table)
    assert "score" in kept.columns and 420 < kept.count() < 520


def test_labels_of_held_out_rows_change_nothing(spark, docs_of):
    rows, labels = corpus(200)
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, q, y in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (toxicity.fit(docs_of(rows), spark.createDataFrame(x, schema)) for x in (labels, flipped))
    assert np.array_equal(a.places, b.places) and np.array_equal(a.values, b.values) and a.bias == b.bias


def test_no_labels_and_no_documents(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {round(r["score"], 6) for r in toxicity.toxic_scores(docs_of(["a b", "c"]), none).collect()} == {0.1}
    assert toxicity.toxic_scores(docs_of(["a"]).where("false"), none).count() == 0


def test_query_on_held_out_rows(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.1")
    got = QUERIES["op10_ftrl_toxicity"](spark, big).where("held_out").select("doc_id", "predicted")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    rows = [(r["predicted"], r["toxic"]) for r in got.join(labels, "doc_id").collect()]
    hit = sum(p and y for p, y in rows)
    print("held-out rows", len(rows), "precision", hit / max(1, sum(p for p, _ in rows)), "recall", hit / max(1, sum(y for _, y in rows)))
    assert hit / sum(y for _, y in rows) > 0.8 and hit / sum(p for p, _ in rows) > 0.8
