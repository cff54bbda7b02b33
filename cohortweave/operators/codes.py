"""Matching diagnosis and procedure codes against pattern lists."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.values import WHITE_SPACE, strip

# Codes and patterns are only compared when their first two characters agree.
HEAD = 2


def normalize_patterns(patterns: Iterable[str] | None, prefix_matching: bool = True) -> list[str]:
    """Trimmed patterns; with prefix matching a bare code stands for its dotted children."""
    out = []
    for pattern in patterns or ():
        pattern = str(pattern).strip(WHITE_SPACE)
        if not pattern:
            continue
        bare = "*" not in pattern and "." not in pattern
        out.append(pattern + ".*" if bare and prefix_matching else pattern)
    return out


def parse_pattern(pattern: str) -> tuple[str, str]:
    """('prefix' | 'exact', key) of one trimmed pattern."""
    if "*" in pattern:
        return "prefix", pattern.rstrip("*")
    return ("prefix" if pattern.endswith(".") else "exact"), pattern


def code_pattern_match(code: Column, patterns: Iterable[str], same_head: bool = False) -> Column:
    """True where the trimmed code matches a pattern; null and empty codes match nothing.

    `same_head` adds the two-character rule, under which `*` or `E*` match no longer code.
    """
    code = strip(code)
    exact, tests = [], []
    for pattern in patterns:
        pattern = str(pattern or "").strip(WHITE_SPACE)
        if not pattern:
            continue
        kind, key = parse_pattern(pattern)
        if kind == "exact":
            exact.append(key)
            continue
        test = code.startswith(key)
        if same_head and len(key) < HEAD:
            test = test & (F.substring(code, 1, HEAD) == pattern[:HEAD])
        tests.append(test)
    if exact:
        tests.append(code.isin(*exact))
    if not tests:
        return F.lit(False)
    return F.coalesce((code != "") & reduce(lambda a, b: a | b, tests), F.lit(False))


def sample_has_any_code(long: DataFrame, patterns: Iterable[str], code_col: str = "value",
                        sample_col: str = "sample_ID") -> DataFrame:
    """Per sample whether any of its codes matches: (sample, has_code)."""
    match = code_pattern_match(F.col(code_col), patterns, same_head=True)
    return long.where(F.col(sample_col).isNotNull()).groupBy(sample_col).agg(F.bool_or(match).alias("has_code"))


def pattern_keys(pattern: Column) -> Column:
    """struct(key, is_prefix) of a trimmed pattern, as a code is looked up by.

    Under the two-character rule a prefix shorter than that only reaches codes that begin like the pattern text itself.
    """
    key = F.rtrim(pattern, F.lit("*"))
    starred, dotted = F.contains(pattern, F.lit("*")), pattern.endswith(".")
    short = F.char_length(key) < HEAD
    is_prefix = (starred | dotted) & (~short | (F.char_length(pattern) >= HEAD))
    text = F.when(starred & ~short, key).when((starred | dotted) & short & is_prefix, F.substring(pattern, 1, HEAD)).otherwise(pattern)
    return F.struct(text.alias("key"), is_prefix.alias("is_prefix"))


def dotted_children(pattern: Column) -> Column:
    """The native form of prefix matching in `normalize_patterns`: a bare code stands for its dotted children."""
    bare = ~F.contains(pattern, F.lit("*")) & ~F.contains(pattern, F.lit("."))
    return F.when(bare, F.concat(pattern, F.lit(".*"))).otherwise(pattern)


def match_codes(codes: DataFrame, patterns: DataFrame) -> DataFrame:
    """Which codes meet which patterns: the columns of `codes` and the labels of `patterns`, each combination once.

    `codes`: distinct (source, code). `patterns`: labels, pattern_source, key, is_prefix. A code is taken apart into its
    prefixes of the lengths that occur among the patterns, and those meet the keys by equality: no code is compared with
    a pattern it does not match, whatever the number of either.
    """
    labels = [c for c in patterns.columns if c not in ("pattern_source", "key", "is_prefix")]
    lengths = patterns.where("is_prefix").agg(F.collect_set(F.char_length("key")).alias("lengths")).scalar()
    fitting = F.filter("_lengths", lambda n: n <= F.char_length("code"))
    prefixes = F.transform(fitting, lambda n: F.struct(F.substring(F.col("code"), F.lit(1), n).alias("key"), F.lit(True).alias("is_prefix")))
    itself = F.array(F.struct(F.col("code").alias("key"), F.lit(False).alias("is_prefix")))
    keyed = codes.where("code <> ''").withColumn("_lengths", lengths).select("source", "code", F.inline(F.concat(itself, prefixes)))
    met = keyed.join(patterns.withColumnRenamed("pattern_source", "source"), ["source", "key", "is_prefix"])
    return met.select("source", "code", *labels).distinct()
