"""Shell-style glob patterns compiled to Spark predicates."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

GLOB_MARKS = ("*", "?", "[")


def has_glob(pattern: str) -> bool:
    return any(mark in pattern for mark in GLOB_MARKS)


def _set_members(body: str) -> str:
    """Members of a `[...]` set, each escaped for a Java character class."""
    parts = []
    i = 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            low, high = body[i], body[i + 2]
            if low <= high:
                parts.append(f"\\x{{{ord(low):x}}}-\\x{{{ord(high):x}}}")
            i += 3
        else:
            parts.append(f"\\x{{{ord(body[i]):x}}}")
            i += 1
    return "".join(parts)


def glob_to_regex(pattern: str) -> str:
    """Anchored Java regex for one glob: `*`, `?`, `[seq]` and `[!seq]`, case-sensitive."""
    out = []
    i = 0
    while i < len(pattern):
        mark = pattern[i]
        i += 1
        if mark == "*":
            out.append(".*")
        elif mark == "?":
            out.append(".")
        elif mark == "[":
            # A `]` right after the opening (or after `!`) is a member, not the end.
            first = i + 1 if pattern[i:i + 1] == "!" else i
            end = pattern.find("]", first + 1)
            if end < 0:
                out.append("\\[")
                continue
            negated = first > i
            members = _set_members(pattern[first:end])
            if members:
                out.append(f"[{'^' if negated else ''}{members}]")
            else:
                out.append("." if negated else "(?!)")
            i = end + 1
        else:
            out.append(re.escape(mark) if mark.isascii() else mark)
    return "(?s)^" + "".join(out) + "\\z"


def matches_any_glob(column: Column, patterns: Iterable[str], null_as: str | None = None) -> Column:
    """True where the text matches at least one pattern.

    Literals become IN, `abc*` becomes a prefix test (both reach the file scan as pushed filters),
    only the rest needs a regex. `null_as` is the text a null is compared as.
    """
    patterns = [str(p) for p in patterns]
    literals = [p for p in patterns if not has_glob(p)]
    prefixes = [p[:-1] for p in patterns if p.endswith("*") and not has_glob(p[:-1])]
    general = [p for p in patterns if has_glob(p) and not (p.endswith("*") and not has_glob(p[:-1]))]

    tests = []
    if literals:
        tests.append(column.isin(*literals))
    tests += [column.startswith(p) if p else column.isNotNull() for p in prefixes]
    if general:
        tests.append(column.rlike("|".join(f"(?:{glob_to_regex(p)})" for p in general)))
    if not tests:
        return F.lit(False)
    if null_as is not None and _matches_text(null_as, literals, prefixes, general):
        tests.append(column.isNull())
    return reduce(lambda a, b: a | b, tests)


def _matches_text(text: str, literals, prefixes, general) -> bool:
    if text in literals or any(text.startswith(p) for p in prefixes):
        return True
    # Python spells the end anchor \Z and code points \uXXXX.
    def python_form(p):
        spelled = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", glob_to_regex(p))
        return spelled.replace("\\z", "\\Z")

    return any(re.match(python_form(p), text) for p in general)
