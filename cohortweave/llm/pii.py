"""Personal data by weak supervision, in DataFrame functions.

Base spans are strict patterns with checks. Looser candidates (addresses with "(at)", numbers in groups) are judged by labelers that
vote yes, no or abstain: the strict pattern, a check of the content, a gazetteer, the words around, the shape of the edges. The
votes of all documents are counted by pattern; expectation-maximisation over those counts estimates how reliable each
labeler is and how likely each pattern is personal data, without any truth. A logistic regression over votes and shape is
trained on those likelihoods and decides on every candidate. Base spans always stay; decided candidates that touch none are added.

The driver sees counts by pattern only, whose number is bounded by the votes and shapes there are. Texts are read once; a text of n
matches takes n log n steps.

Defined results: a null text counts as empty; U+E000 in a text is read as U+E001 (no pattern holds either); rows repeated under a
doc_id give a row each; equal starts are ordered by kind, then end; added spans of an address and of a number may overlap each other; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.shared import whole_text
from cohortweave.runtime import settle

KINDS = ("email", "ip", "card", "phone")
MARK = "\ue000"
LOCAL = "[A-Za-z0-9._%+-]"
# Possessive, and only where a run begins or the last match ended: the same matches in one pass over the text.
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "contains(t, '@')", "ip": "t RLIKE '[0-9]\\\\.[0-9]'", "card": "t RLIKE '[0-9][ -]?[0-9]'", "phone": "contains(t, '+')"}
OCTETS = r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\\.|$)){4}"
DIGITS = "regexp_replace({m}, '[^0-9]', '')"
HOLDS = {
    "email": "true",
    "ip": "{m} RLIKE '" + OCTETS + "'",
    "card": f"length({DIGITS}) BETWEEN 14 AND 19 AND luhn_check({DIGITS})",
    "phone": f"length({DIGITS}) BETWEEN 10 AND 15",
}
LOOSE = {
    "mail": rf"(?<!{LOCAL}){LOCAL}++(?:@|\x20?[\[(]\x20?at\x20?[\])]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?)[A-Za-z0-9-]++)*+",
    "number": r"(?<![A-Za-z0-9.])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9])++",
}
LOOSE_NEEDS = {"mail": "contains(t, '@') OR t RLIKE '[\\\\[(] ?at ?[\\\\])]'", "number": "t RLIKE '[0-9][ ().-]{0,2}[0-9]'"}
# gazetteers: ends of domain names, first digits of card numbers, dialling codes
DOMAIN_ENDS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|us|ch|at|nl|be|pl|ca|au|jp|br|mx"
CARD_STARTS = "4|5[1-5]|2[2-7]|3[47]|6011|65"
DIAL_CODES = "1|7|20|27|3[0-4]|36|39|4[0-1]|4[3-9]|5[1-8]|6[0-6]|8[1-2]|84|86|9[0-5]|98"
CUES = "mail|e-mail|contact|write|phone|tel|call|fax|mobile|card|visa|account|host|server|address|ip"
AGAINST = "isbn|version|page|section|chapter|id|no|order|invoice|release|license"
VOTES = ("pattern", "content", "gazetteer", "context", "edge")
SHAPES = ("plus", "bracket", "digits")


def text_of(pattern: str) -> str:
    """A pattern as a SQL string."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def running_sum(array: str) -> str:
    """SQL for the running sums of an array of longs: in turn j every place adds the one 2^j before it, so n places take log n turns."""
    return f"""transform(array({array}), x -> aggregate(sequence(0, length(bin(size(x))) - 1), x, (acc, j) ->
        transform(acc, (v, i) -> v + IF(i >= shiftleft(1, j), acc[i - shiftleft(1, j)], 0L))))[0]"""


def matches(pattern: str, needs: str) -> str:
    """SQL for the matches of a pattern in `t`: array of (start, end, m, before, after), in code points."""
    parts = f"split(regexp_replace(t, {text_of(pattern)}, '{MARK}$0{MARK}'), '{MARK}')"
    found = f"""transform(array({running_sum("transform(p, s -> CAST(char_length(s) AS BIGINT))")}), e -> transform(
        filter(sequence(1, size(p) - 1), i -> i % 2 = 1), i -> named_struct('start', e[i - 1], 'end', e[i], 'm', p[i],
        'before', right(p[i - 1], 24), 'after', left(get(p, i + 1), 16))))[0]"""
    none = "CAST(array() AS ARRAY<STRUCT<start: BIGINT, end: BIGINT, m: STRING, before: STRING, after: STRING>>)"
    return f"CASE WHEN {needs} THEN transform(array({parts}), p -> IF(size(p) > 1, {found}, {none}))[0] ELSE {none} END"


def base_spans() -> str:
    """SQL for the base spans of `t`: array of (start, kind, end); kind is its place in KINDS."""
    each = [f"transform(filter({matches(BASE[kind], NEEDS[kind])}, s -> {HOLDS[kind].replace('{m}', 's.m')}), "
            f"s -> named_struct('start', s.start, 'kind', {i}, 'end', s.end))" for i, kind in enumerate(KINDS)]
    return f"array_sort(concat({', '.join(each)}))"


def judged(array: str, source: str) -> str:
    """SQL: candidates with kind, votes (1, 0, null) and shape."""
    d = DIGITS.replace("{m}", "c.m")
    if source == "mail":
        kind, digits = "0", "0"
        pattern = f"c.m RLIKE {text_of(f'^{LOCAL}+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+$')}"
        content = "c.m RLIKE '[A-Za-z]' AND c.m RLIKE '(\\\\.|dot ?[\\\\])]) ?[A-Za-z]{2,}$'"
        gazetteer = f"lower(c.m) RLIKE '[^a-z]({DOMAIN_ENDS})$'"
        keep = "true"
    else:
        digits = f"length({d})"
        kind = f"CASE WHEN c.m RLIKE {text_of('^[0-9]+([.][0-9]+){3}$')} THEN 1 WHEN {digits} >= 13 AND NOT c.m LIKE '+%' THEN 2 ELSE 3 END"
        pattern = f"CASE {kind} WHEN 1 THEN true WHEN 2 THEN NOT c.m RLIKE '[().]' ELSE c.m LIKE '+%' END"
        content = f"CASE {kind} WHEN 1 THEN c.m RLIKE '{OCTETS}' WHEN 2 THEN {digits} BETWEEN 14 AND 19 AND luhn_check({d}) ELSE {digits} BETWEEN 10 AND 15 END"
        gazetteer = (f"CASE {kind} WHEN 1 THEN NOT c.m RLIKE '^0' WHEN 2 THEN {d} RLIKE '^({CARD_STARTS})' "
                     f"ELSE IF(c.m LIKE '+%', {d} RLIKE '^({DIAL_CODES})', {d} RLIKE '^[2-9]') END")
        keep = f"{digits} BETWEEN 7 AND 19"
    around = "lower(concat(coalesce(c.before, ''), ' ', coalesce(c.after, '')))"
    context = f"CASE WHEN {around} RLIKE '\\\\b({CUES})\\\\b' THEN 1 WHEN {around} RLIKE '\\\\b({AGAINST})\\\\b' THEN 0 END"
    edge = "NOT (coalesce(c.before, '') RLIKE '[\\\\p{L}\\\\p{N}#$]$' OR coalesce(c.after, '') RLIKE '^[\\\\p{L}\\\\p{N}%]')"
    return f"""transform(filter({array}, c -> {keep}), c -> named_struct('start', c.start, 'kind', {kind}, 'end', c.end,
        'pattern', CAST({pattern} AS INT), 'content', CAST({content} AS INT), 'gazetteer', CAST({gazetteer} AS INT), 'context', {context},
        'edge', CAST({edge} AS INT), 'plus', CAST(c.m LIKE '+%' AS INT), 'bracket', CAST(c.m RLIKE '[(]' AS INT), 'digits', CAST({digits} AS INT)))"""


def reliabilities(patterns: dict[tuple, int], turns: int = 40) -> tuple[dict[tuple, float], list[tuple[float, float]]]:
    """Likelihood of each vote pattern, and each labeler's chance to vote yes on personal data and on other spans.

    Dawid and Skene's model with two classes, started from the majority; one count is added to every cell.
    """
    yes = {}
    for votes in patterns:
        cast = [v for v in votes if v is not None]
        yes[votes] = (sum(cast) + 0.5) / (len(cast) + 1)
    rates: list[tuple[float, float]] = []
    for _ in range(turns):
        total = sum(patterns.values()) or 1
        prior = min(0.99, max(0.01, sum(yes[v] * n for v, n in patterns.items()) / total))
        rates = []
        for i in range(len(VOTES)):
            a = [1.5, 1.0, 1.0, 1.5]  # yes and no on personal data, yes and no on others
            for votes, n in patterns.items():
                if votes[i] is not None:
                    a[1 - votes[i]] += yes[votes] * n
                    a[3 - votes[i]] += (1 - yes[votes]) * n
            rates.append((a[0] / (a[0] + a[1]), a[2] / (a[2] + a[3])))
        for votes in patterns:
            odds = math.log(prior / (1 - prior))
            for v, (p, q) in zip(votes, rates):
                if v is not None:
                    odds += math.log(p / q) if v else math.log((1 - p) / (1 - q))
            yes[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return yes, rates


def span_features(kind: int, votes: tuple, shape: tuple) -> list[float]:
    """What the classifier sees; `score_of` says the same in SQL."""
    plus, bracket, digits = shape
    out = [1.0] + [float(kind == k) for k in range(len(KINDS))]
    for v in votes:
        out += [float(v == 1), float(v == 0)]
    return out + [float(plus), float(bracket), float(10 <= digits <= 15), float(13 <= digits <= 19)]


def fit_classifier(rows: list[tuple[list[float], float, int]], turns: int = 300, rate: float = 0.5, ridge: float = 1e-3) -> list[float]:
    """Logistic regression on soft labels: (features, likelihood, count)."""
    size = len(span_features(0, (None,) * len(VOTES), (0, 0, 0)))
    w, total = [0.0] * size, sum(n for _, _, n in rows)
    if not total:
        return [-1.0] + w[1:]
    for _ in range(turns):
        slope = [ridge * x for x in w]
        for x, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x))))))
            for i, b in enumerate(x):
                if b:
                    slope[i] += (p - y) * b * n / total
        w = [a - rate * g for a, g in zip(w, slope)]
    return w


def score_of(w: list[float], c: str = "c") -> str:
    """SQL for the log odds of a candidate."""
    terms = [f"{c}.kind = {k}" for k in range(len(KINDS))]
    for v in VOTES:
        terms += [f"{c}.{v} <=> 1", f"{c}.{v} <=> 0"]
    terms += [f"{c}.plus = 1", f"{c}.bracket = 1", f"{c}.digits BETWEEN 10 AND 15", f"{c}.digits BETWEEN 13 AND 19"]
    return " + ".join([f"{w[0]!r}D"] + [f"IF({t}, {x!r}D, 0D)" for t, x in zip(terms, w[1:])])


def find_candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, base, candidates) of every row; written once, without the texts."""
    text = F.when(F.contains(whole_text(), F.lit(MARK)), F.translate(whole_text(), MARK, "\ue001")).otherwise(whole_text())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"))
    loose = [judged(matches(LOOSE[s], LOOSE_NEEDS[s]), s) for s in LOOSE]
    return settle(rows.select("doc_id", F.expr(base_spans()).alias("base"), F.expr(f"concat({', '.join(loose)})").alias("candidates")))


def learn(found: DataFrame) -> list[float]:
    """The classifier's weights, from all candidates of `find_candidates`."""
    votes = found.select(F.explode("candidates").alias("c")).select("c.kind", *[f"c.{v}" for v in VOTES], *[f"c.{s}" for s in SHAPES])
    counted = votes.groupBy(*votes.columns).agg(F.count(F.lit(1)).alias("n")).collect()  # bounded by votes and shapes
    by_kind: dict[int, dict[tuple, int]] = defaultdict(lambda: defaultdict(int))
    rows = []
    for r in counted:
        rows.append((r["kind"], tuple(r[v] for v in VOTES), tuple(r[s] for s in SHAPES), r["n"]))
        by_kind[r["kind"]][rows[-1][1]] += r["n"]
    likely = {kind: reliabilities(patterns)[0] for kind, patterns in by_kind.items()}
    rows.sort(key=str)
    return fit_classifier([(span_features(kind, v, s), likely[kind][v], n) for kind, v, s, n in rows])


def touches(base: str, c: str) -> str:
    """SQL: whether a candidate overlaps any of `base`. The spans of one kind don't overlap, so the last that starts before the
    candidate's end, found by halving steps, decides for its kind."""
    last = f"""aggregate(reverse(sequence(0, length(bin(size(b))) - 1)), 0, (at, j) ->
        IF(at + shiftleft(1, j) <= size(b) AND get(b, at + shiftleft(1, j) - 1).start < {c}.end, at + shiftleft(1, j), at))"""
    return f"exists({base}, b -> coalesce(get(b, {last} - 1).end > {c}.start, false))"


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added): arrays of (start, kind, end), sorted."""
    found = find_candidates(docs)
    odds = score_of(learn(found))
    kinds = ", ".join(f"filter(base, b -> b.kind = {i})" for i in range(len(KINDS)))
    added = f"""transform(array(array({kinds})), kinds -> transform(filter(candidates, c -> {odds} >= 0 AND NOT {touches("kinds", "c")}),
        c -> named_struct('start', c.start, 'kind', c.kind, 'end', c.end)))[0]"""
    return found.select("doc_id", "base", F.expr(f"array_sort({added})").alias("added"))


def as_text(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, s -> concat(element_at(array({names}), s.kind + 1), ':', s.start, ':', s.end)), ',')"
