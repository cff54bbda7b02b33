"""Spelling variants by PartEnum signatures.

A word stands for the set of its letters numbered by occurrence (`banana`: a1 a2 a3 b1 n1 n2), a binary vector. One replaced letter
changes two places of it, an inserted or deleted one changes one. The places are dealt over `parts` partitions by a hash; of
`parts` partitions with `far` changed places some `parts - far` are equal, so all choices of that many are enumerated, and each gives
a signature. Words of equal length meet under signatures for a distance of two (six of them), words of lengths m and
m + 1 under signatures for a distance of one (three), and what meets is verified by the edit distance.

Letters alone would bring all permutations of the same syllables together. An edit leaves the first or the last half of a word
alone, so a signature also holds the shorter word's length and one half of the word, once each: near words still share
one, and a signature's group stays small. Groups are compared inside an equality join, which deals out large ones; only verified pairs leave it.

Counting is combined per task before the shuffle; the table of signatures is written once. A chain of forms grows tenfold
at each step, so it has at most 19 steps for counts below 2**63, which five rounds of doubling cover.

Defined results: a null text has no words; a null doc_id counts as an empty one; rows repeated under a doc_id all count; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.runtime import settle

LEAST = 7  # code points of a word
RARITY = 10  # a form is so many times as frequent
HELD = 400_000  # distinct words that a task counts before it passes them on
DAMAGE = 31
UPPER = {c: c + 32 for c in range(65, 91)}
TWO_AWAY, ONE_AWAY = (4, 2), (3, 1)  # partitions, changed places


def words_of(doc_id: int | None, text: str, least: int = LEAST) -> Counter:
    """Counts of a document's words: runs of letters, A-Z in lower case, some without one code point."""
    out, start = Counter(), zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
    for run, n in Counter(re.findall("[A-Za-zÀ-ÿ]{%d,}" % least, text)).items():
        word = run.lower() if run.isascii() else run.translate(UPPER)
        fate = zlib.crc32(word.encode(), start)
        if fate % DAMAGE == 0:
            place = fate % len(word)
            word = word[:place] + word[place + 1:]
            if len(word) < least:
                continue
        out[word] += n
    return out


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(word, n) of words that occur twice or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()

        def emit():
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text:
                    for word, n in words_of(doc_id, text, least).items():
                        counts[word] += n
                if len(counts) >= HELD:
                    yield emit()
        yield emit()

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where("n >= 2")


class Places(dict):
    """A hash for each (letter, occurrence), drawn from its number."""

    def __missing__(self, place: tuple[str, int]) -> int:
        found = self[place] = xxhash.xxh64_intdigest(f"{place[1]}{place[0]}")
        return found


PLACES = Places()


def part_sums(word: str, parts: int) -> list[int]:
    """The sum of the hashes of the word's numbered letters in each partition."""
    seen, sums = {}, [0] * parts
    for letter in word:
        seen[letter] = n = seen.get(letter, 0) + 1
        place = PLACES[letter, n]
        sums[place % parts] += place >> 4
    return sums


def signatures(word: str, shorter: int, parts: int, far: int) -> list[int]:
    """Hashes (signed) that a word shares with some other of the distance `far` whose shorter one has `shorter` letters."""
    sums, half, out = part_sums(word, parts), shorter // 2, []
    for side, kept in (("<", word[:half]), (">", word[len(word) - half:])):
        for chosen in combinations(range(parts), parts - far):
            key = xxhash.xxh64_intdigest(f"{far}{side}{shorter} {chosen} {[sums[i] for i in chosen]} {kept}")
            out.append(key - (key >> 63 << 64))
    return out


def signed_words(words: DataFrame) -> DataFrame:
    """`words` with `equal`, `as_short`, `as_long`: signatures for words of the same length, one letter more, one less."""
    schema = "word string, n long, equal array<long>, as_short array<long>, as_long array<long>"
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            keys = [[signatures(w, len(w) - less, *away) for w in words] for less, away in ((0, TWO_AWAY), (0, ONE_AWAY), (1, ONE_AWAY))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(k, longs) for k in keys)], names=["word", "n", "equal", "as_short", "as_long"])

    return words.select("word", "n").mapInArrow(run, schema)


def near_pairs(signed: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every two words one edit apart, each pair once."""
    one_edit = F.call_function("levenshtein", F.col("word"), F.col("near"), F.lit(1)) == 1
    index = lambda kind, *names: signed.select(F.explode(kind).alias("key"), "word", "n").toDF("key", *names)
    other = ("near", "near_n")
    replaced = index("equal", "word", "n").join(index("equal", *other), "key").where((F.col("word") < F.col("near")) & one_edit)
    longer = index("as_short", "word", "n").join(index("as_long", *other), "key").where(one_edit)
    return replaced.union(longer).select("word", "n", *other).distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where following the forms ends."""
    roots = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        later = roots.toDF("root", "later")
        going = roots.join(later, "root", "left")
        further = settle(going.select("word", F.coalesce("later", "root").alias("root"), F.col("later").isNotNull().alias("moved")))
        roots = further.select("word", "root")
        if further.where("moved").isEmpty():
            return roots


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    signed = settle(signed_words(word_counts(docs)))
    pairs = near_pairs(signed)
    ways = pairs.select(F.explode(F.array(F.struct("word", "n", "near", "near_n"), F.struct(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))).alias("w")).select("w.*")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))  # the most frequent one, the smallest of equals
    near = ways.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    common = -F.col("best.less") >= RARITY * F.col("n")
    found = signed.select("word", "n").join(near, "word", "left")
    found = settle(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(common, F.col("best.near")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n")))
    out = found.join(last_forms(found.where("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
