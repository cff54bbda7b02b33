"""Rows without a doc_id, and rows that share one, are documents of their own."""

from cohortweave.llm import lines, simhash, substrings

A = " ".join("alpha%d" % i for i in range(30))
B = " ".join("beta%d" % i for i in range(30))
C = " ".join("gamma%d" % i for i in range(30))


def test_one_row_of_each_group_stays_whatever_the_ids(docs_of):
    rows = [(None, A, "s"), (None, B, "s"), (None, B, "s"), (None, C, "s"), (7, C, "s"), (7, A + " x", "s"), (7, "short text", "s"), (9, "short text", "s")]
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in simhash.one_per_group(docs_of(rows)).collect())
    groups = simhash.rooted(simhash.fingerprints(docs_of(rows)), 4, 20_000).select("root").distinct().count()
    assert len(kept) == groups
    assert (0, B) in kept and (7, C) in kept and (7, "short text") in kept and (0, C) not in kept
    assert any(t.startswith(A) for _, t in kept)


def test_lines_go_only_where_they_repeat(docs_of):
    rows = [(None, f"{A}\nfirst own {B}", "s"), (None, f"{C}\nsecond own line", "s"), (3, "x one\nunlike two", "s"), (3, f"{A}\nrest of three", "s"), (4, C, "s")]
    got = {(r["doc_id"], r["text"]) for r in lines.without_repeats(docs_of(rows)).collect()}
    assert got == {(None, rows[0][1]), (None, rows[1][1]), (3, rows[2][1]), (3, "rest of three"), (4, "")}


def test_words_go_only_where_they_repeat(docs_of):
    rows = [(None, f"{A} own", "s"), (None, f"{B} other", "s"), (3, C, "s"), (3, f"{A} rest", "s"), (4, f"tail {B}", "s")]
    got = {(r["doc_id"], r["kept"]) for r in substrings.without_repeats(docs_of(rows)).collect()}
    assert got == {(None, rows[0][1]), (None, rows[1][1]), (3, C), (3, "rest"), (4, "tail")}
    twins = [(None, f"{A} a", "s"), (None, f"b {A}", "s")]
    assert sorted(r["n_removed"] for r in substrings.without_repeats(docs_of(twins)).collect()) == [0, 30]
