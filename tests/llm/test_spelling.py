import re
import zlib
from collections import Counter

from cohortweave.llm import spelling
from cohortweave.llm.queries import QUERIES


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def words_by_hand(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            fate = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if fate % 31 == 0:
                word = word[:fate % len(word)] + word[fate % len(word) + 1:]
            if len(word) >= 7:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def by_hand(docs):
    counts = words_by_hand(docs)
    near = {w: set() for w in counts}
    some = sorted(counts, key=len)
    for i, a in enumerate(some):
        for b in some[i + 1:]:
            if len(b) - len(a) > 1:
                break
            if sum(((Counter(a) - Counter(b)) + (Counter(b) - Counter(a))).values()) <= 2 and edit_distance(a, b) == 1:
                near[a].add(b)
                near[b].add(a)
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= 10 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = forms[w], root, counts[w], len(near[w]), counts.get(forms[w])
    return out


def answer(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_every_edit_of_a_word_shares_a_signature():
    letters = "abcé"
    for word in ("bananas", "aaaaaaa", "reordered", "élémentaire"):
        for i in range(len(word) + 1):
            for x in letters:
                longer = word[:i] + x + word[i:]
                assert set(spelling.signatures(word, len(word), *spelling.ONE_AWAY)) & set(spelling.signatures(longer, len(word), *spelling.ONE_AWAY))
                if i < len(word):
                    other = word[:i] + x + word[i + 1:]
                    assert set(spelling.signatures(word, len(word), *spelling.TWO_AWAY)) & set(spelling.signatures(other, len(word), *spelling.TWO_AWAY))


def test_forms_and_roots(spark, docs_of):
    rows = [(i, t, "s") for i, t in enumerate(
        ["weather " * 400 + "wether weathers weathers", "weathre weathre wheather wheather " + "weathar " * 30, "weathas weathas weathax " * 2, None, "", "short " * 50,
         "ÀÉÎÕÜßÿ ÀÉÎÕÜßÿ àéîõüßÿ×÷ àéîõüßÿ×÷", "Anagrams anagrams managras managras", "weather's WEATHER weatherweather"])]
    rows += [(None, "weather nullword nullword", "s"), (3, "weathers weathers", "s"), (3, "weathers weathers", "s")]
    got = answer(spelling.spelling_variants(docs_of(rows, extra="word")))
    assert got == by_hand([(r[0], r[1]) for r in rows])
    assert got["weathax"][1] == "weather" and got["weathar"][0] == "weather"


def test_chain_of_forms(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(19)], "word string, form string")
    assert {tuple(r) for r in spelling.last_forms(forms).collect()} == {(f"w{i}", "w19") for i in range(19)}
    assert spelling.last_forms(forms.where("false")).count() == 0


def test_many_words_under_few_letters(spark, docs_of):
    import itertools

    words = ["".join(p) for p in itertools.product("ab", repeat=9)]
    docs = docs_of([" ".join(words), " ".join(words[::2] * 3)])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert answer(spelling.spelling_variants(docs)) == by_hand(rows)


def test_empty_table(docs_of):
    assert spelling.spelling_variants(docs_of(["x"]).where("false")).count() == 0


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert answer(QUERIES["op12_partenum_spelling"](spark, sf_dir)) == by_hand(docs)
