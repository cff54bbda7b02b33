"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, of their stems (the first four and six letters), of neighbouring words and of
words with one between. Every coordinate has its own learning rate, and the L1 term keeps most of them at exactly zero, so
the model that travels is a short list of places and weights (2^20 at most).

The model is fitted on at most `most` labelled rows, those with the smallest hash of their doc_id: a bounded sample in one
task, so losing its executor costs one repetition. Everything else covers all rows.

Defined results: a null text counts as empty, an empty text scores the bias alone; without labelled rows every score is
the prior; several labels of a document count as several rows; a null label counts for nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN = regex.compile(r"[\p{L}\p{N}']+")
MIX1, MIX2, MIX3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.0
    epochs: int = 6
    most: int = 20_000  # labelled rows that are fitted on
    prior: float = 0.1


class Hashes(dict):
    """The hashes of a word and of its stems; a full table starts anew."""

    def __missing__(self, word: str) -> tuple[int, int, int]:
        found = xxhash.xxh64_intdigest(word, 7), xxhash.xxh64_intdigest(word[:4], 11), xxhash.xxh64_intdigest(word[:6], 13)
        if len(word) <= 64:
            if len(self) >= 500_000:
                self.clear()
            self[word] = found
        return found


def features(text: str | None, known: Hashes, bits: int) -> np.ndarray:
    """Distinct places in [0, 2^bits)."""
    tokens = TOKEN.findall((text or "").lower())
    if not tokens:
        return np.empty(0, np.int64)
    both = np.array(list(map(known.__getitem__, tokens)), np.uint64)
    words = both[:, 0]
    pairs = words[:-1] * MIX1 ^ words[1:] * MIX2
    skips = words[:-2] * MIX1 ^ words[2:] * MIX3
    found = np.concatenate((both.ravel(), pairs, skips)) * MIX2
    return np.unique((found >> np.uint64(64 - bits)).astype(np.int64))


def value(places: np.ndarray) -> float:
    """The value of each feature: long texts have more of them, each a little smaller."""
    return 1.0 / max(1.0, len(places)) ** 0.25


class Ftrl:
    """McMahan's FTRL-proximal with per-coordinate rates; the last place is the bias, without L1."""

    def __init__(self, s: Settings):
        self.s = s
        self.z, self.n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)
        self.bias_z = self.bias_n = 0.0

    def weights(self, places: np.ndarray) -> np.ndarray:
        s, z = self.s, self.z[places]
        w = (np.sign(z) * s.l1 - z) / ((s.beta + np.sqrt(self.n[places])) / s.alpha + s.l2)
        return np.where(np.abs(z) <= s.l1, 0.0, w)

    def bias(self) -> float:
        return -self.bias_z / ((self.s.beta + np.sqrt(self.bias_n)) / self.s.alpha)

    def learn(self, places: np.ndarray, label: int) -> None:
        s, x = self.s, value(places)
        w, b = self.weights(places), self.bias()
        g = 1 / (1 + np.exp(-np.clip(b + x * w.sum(), -30, 30))) - label
        step = g * x
        sigma = (np.sqrt(self.n[places] + step * step) - np.sqrt(self.n[places])) / s.alpha
        self.z[places] += step - sigma * w
        self.n[places] += step * step
        sigma = (np.sqrt(self.bias_n + g * g) - np.sqrt(self.bias_n)) / s.alpha
        self.bias_z += g - sigma * b
        self.bias_n += g * g


@dataclass(frozen=True)
class Model:
    places: np.ndarray
    values: np.ndarray
    bias: float
    bits: int

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.bits)
        w[self.places] = self.values
        return w


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, label) of at most `most` rows; ids whose crc32 leaves 2 modulo 4 are held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("label")).dropna()
    known = known.where(~held_out("_id")).withColumn("_turn", F.xxhash64(F.lit(17), "_id"))
    known = known.orderBy("_turn", "_id", "label").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    return F.broadcast(known).join(texts, "_id").select("_id", "_turn", "text", "label")  # `most` rows of three numbers


def gathered_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """`labelled_rows` in one partition, by an exchange behind the join: all tasks read the documents, one gets the rows found.

    The bound holds for rows as well: under ids that documents share, the first `most` rows by label order and hash of the text stay.
    """
    rows = labelled_rows(docs, labels, most).orderBy("_turn", "_id", "label", F.xxhash64("text")).limit(most)
    return rows.repartition(1)


def held_out(name: str):
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    s = settings

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, rows = Hashes(), []
        for batch in batches:
            rows += [(turn, i, features(t, known, s.bits).astype(np.int32), y) for i, turn, t, y in batch.itertuples(index=False)]
        rows.sort(key=lambda r: (r[0], r[1], r[3], len(r[2])))
        model = Ftrl(s)
        prior = np.clip(sum(r[3] for r in rows) / len(rows), 1e-4, 1 - 1e-4) if rows else s.prior
        rng = np.random.default_rng(5)
        for _ in range(s.epochs):
            for i in rng.permutation(len(rows)):
                model.learn(rows[i][2], rows[i][3])
        w = model.weights(np.arange(1 << s.bits))
        at = np.flatnonzero(w)
        bias = model.bias() if rows else float(np.log(prior / (1 - prior)))
        yield pd.DataFrame({"place": np.append(at, -1), "value": np.append(w[at], bias)})

    found = gathered_rows(docs, labels, s.most).mapInPandas(train, "place long, value double").toPandas()
    bias = found.loc[found["place"] < 0, "value"]
    found = found[found["place"] >= 0]
    base = float(bias.iloc[0]) if len(bias) else float(np.log(s.prior / (1 - s.prior)))
    return Model(found["place"].to_numpy(), found["value"].to_numpy(), base, s.bits)


def score(texts: Column, model: Model, spark: SparkSession) -> Column:
    """The probability of label 1 of each text."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        w, known = m.dense(), Hashes()
        for batch in batches:
            found = [features(t, known, m.bits) for t in batch]
            yield pd.Series([1 / (1 + np.exp(-np.clip(m.bias + value(f) * w[f].sum(), -30, 30))) for f in found], dtype=float)

    return F.pandas_udf(run, "double")(texts)


def toxic_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    scores = score(F.col("text"), fit(docs, labels, settings), docs.sparkSession)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scores.alias("score"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` that score below the threshold."""
    return docs.where(score(F.col("text"), fit(docs, labels, settings), docs.sparkSession) < threshold)
