import hashlib
import random
import re

import pytest

from cohortweave.llm import pii
from cohortweave.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer(PLAIN[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0,
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def random_text(rng):
    parts = ["a.b@c.de", "a@b.c%x@y.z", "@", "x@y", "4041894974608795", "4111-1111 1111 1111", "1.2.3.4.5.6.7.8", "300.1.1.1", "0255.001.2.3",
             "+1 (988) 555-2485", "+12", "+1 23 45 67 89 01 23 45 67 89", "é€😀", "", "word", " ", "\n", ".", "-", "7", "12 34", "%", "+"]
    return "".join(rng.choice(parts) + rng.choice(["", " ", ""]) for _ in range(rng.randrange(30)))


def test_base_spans_equal_plain_matching(docs_of):
    rng = random.Random(9)
    texts = [None, "", *[random_text(rng) for _ in range(400)], "1" * 50_000, "a" * 60_000 + "@x.y", "1." * 20_000, "+" + "1 " * 30_000, "9-" * 30_000]
    rows = pii.personal_data(docs_of(texts, extra="base")).collect()
    got = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in rows}
    assert got == {i: plain_spans(t) for i, t in enumerate(texts)}


def test_em_finds_the_reliable_labelers():
    rng = random.Random(1)
    chances = [(0.95, 0.05), (0.9, 0.1), (0.5, 0.5), (0.8, 0.3), (0.85, 0.2)]
    patterns = {}
    for _ in range(4000):
        truth = rng.random() < 0.4
        votes = tuple(int(rng.random() < (p if truth else q)) if rng.random() < 0.8 else None for p, q in chances)
        patterns[votes] = patterns.get(votes, 0) + 1
    _, rates = pii.reliabilities(patterns)
    for got, real in zip(rates, chances):
        assert got == pytest.approx(real, abs=0.08)


def test_candidates_are_added_and_base_stays(docs_of):
    texts = [f"call me: (212) 555-{1000 + i} today" for i in range(30)] + [f"mail joe{i} (at) firm{i}.com now" for i in range(30)]
    texts += [f"mail a{i}@b{i}.org and phone +1 212 555 {1000 + i}" for i in range(40)] + [f"isbn no 3-{10000 + i}-99 x" for i in range(40)]
    rows = {r["doc_id"]: r for r in pii.personal_data(docs_of(texts)).collect()}
    assert all(len(rows[i]["base"]) == 2 for i in range(60, 100))
    mails = [s for i in range(30, 60) for s in rows[i]["added"]]
    assert len(mails) == 30 and {s["kind"] for s in mails} == {0}
    assert not any(rows[i]["added"] for i in range(100, 140))
    for r in rows.values():
        assert not any(a["start"] < b["end"] and b["start"] < a["end"] for a in r["added"] for b in r["base"])


def test_many_matches_in_one_text(docs_of):
    text = " ".join(f"u{i}@h{i}.org, joe{i} (at) firm{i}.com or +1 212 555 {1000 + i % 9000}" for i in range(20_000))
    row = pii.personal_data(docs_of([text, "x"])).where("doc_id = 0").first()
    assert [tuple(s) for s in row["base"]] == plain_spans(text) and len(row["base"]) == 40_000


def test_touching_equals_comparing_all(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        base = []
        for kind in range(4):
            ends = sorted(rng.sample(range(60), 2 * rng.choice([0, 1, 1, 2, 5])))
            base += [(s, kind, e) for s, e in zip(ends[::2], ends[1::2])]
        start = rng.randrange(60)
        rows.append((i, sorted(base), (start, start + rng.randrange(1, 9))))
    df = spark.createDataFrame(rows, "i int, base array<struct<start: bigint, kind: int, end: bigint>>, c struct<start: bigint, end: bigint>")
    kinds = ", ".join(f"filter(base, b -> b.kind = {k})" for k in range(4))
    got = {r["i"]: r["hit"] for r in df.selectExpr("i", f"{pii.touches(f'array({kinds})', 'c')} AS hit").collect()}
    assert got == {i: any(s < c[1] and c[0] < e for s, _, e in base) for i, base, c in rows}
    assert set(got.values()) == {True, False}


def test_empty_and_repeated(docs_of):
    assert pii.personal_data(docs_of(["x"]).where("false")).count() == 0
    assert pii.personal_data(docs_of([(1, "a@b.c", "s"), (1, "a@b.c", "s"), (None, None, None)])).count() == 3


def test_query(spark, sf_dir):
    rows = QUERIES["op4_weak_supervision_pii"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_spans(texts[r["doc_id"]])
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(k == s[1] for s in spans) for k in range(4)]
        assert set(text.split(",")) - {""} <= set(r["spans"].split(","))
