import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortweave.llm import large_items as p
from cohortweave.llm.queries import QUERIES, tokenizer_path


def sequences_of(lines):
    out = defaultdict(list)
    for line, n in lines:
        for i in range(n):
            out[line.sequence + i // line.each].append((line.offset + i % line.each * line.length, line.length))
    return out


def with_counts(lines, counts):
    """Each line with the number of documents it places: up to the next line of its length."""
    by_length = defaultdict(list)
    for line in sorted(lines):
        by_length[line.length].append(line)
    for length, own in by_length.items():
        for line, after in zip(own, [*own[1:], None]):
            yield line, (after.rank if after else counts[length]) - line.rank


def best_fit_by_hand(counts, capacity):
    """Sequences needed when every document is put one by one."""
    large = sorted((n for n, k in counts.items() for _ in range(k) if 3 * n > capacity), reverse=True)
    rooms = []
    while large:
        longest = large.pop(0)
        partner = next((n for n in large if n + longest <= capacity), None)
        if partner:
            large.remove(partner)
        rooms.append(capacity - longest - (partner or 0))
    for n in sorted((n for n, k in counts.items() for _ in range(k) if 3 * n <= capacity), reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 60, 2048])
    counts = Counter(min(capacity, max(1, int(rng.choice([rng.expovariate(4 / capacity), rng.uniform(1, capacity)])))) for _ in range(rng.choice([1, 30, 700])))
    lines, opened = p.packing_plan(counts, capacity)
    out = sequences_of(with_counts(lines, counts))
    assert set(out) == set(range(opened)) and opened == best_fit_by_hand(counts, capacity)
    assert Counter(n for items in out.values() for _, n in items) == counts
    for items in out.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= capacity


def test_plan_does_not_grow_with_the_table():
    small = {n: 1 + n * 7919 % 13 for n in range(1, 2049)}
    lines, _ = p.packing_plan({n: k * 10**9 + n for n, k in small.items()})
    assert len(lines) < 12 * 3 * 2048
    assert p.packing_plan({}) == ([], 0)


def packed_by_hand(rows, docs):
    """Checks what the contract fixes of packed rows; (sequences, tokens)."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected = Counter()
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = ids[start:start + 2048]
            expected[doc_id, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in sequences.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= 2048
    return len(sequences), sum(r["length"] for r in rows)


def test_odd_documents(spark, docs_of):
    rows = [(1, None, "s"), (1, "", "s"), (1, "same text", "s"), (1, "same text", "s"), (None, "no id", "s"), (2, "word " * 2047, "s"), (3, "word " * 2048, "s"),
            (4, "a b\nc " * 3000, "s"), (5, "ÄÉ 日本 It's 1,000.5!", "s")] + [(i, "x", None) for i in range(10, 400)]
    got = p.pack_documents(docs_of(rows, extra="length"), tokenizer_path()).collect()
    packed_by_hand(got, [(r[0], r[1]) for r in rows])
    assert p.pack_documents(docs_of(["x"]).where("false"), tokenizer_path()).count() == 0


def test_other_tokenizers_are_refused():
    import public_tokenizers

    assert p.checked_words(tokenizer_path()).checked
    with pytest.raises(ValueError, match="word by word"):
        p.checked_words(public_tokenizers.path("byte_bpe_50k.json"))


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    n, tokens = packed_by_hand(QUERIES["op13_large_item_packing"](spark, sf_dir).collect(), docs)
    assert n <= 1.01 * -(-tokens // 2048) + 1
