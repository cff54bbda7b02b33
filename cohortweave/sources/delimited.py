"""Readers for delimited text: raw tables, canonical long tables, sample lists."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.functions.values import normalize_nulls, strip
from cohortweave.runtime import quoted

# Separator names and the separator implied by a file extension.
SEPARATOR_NAMES = {
    "tsv": "\t", "tab": "\t", "csv": ",", "comma": ",", "pipe": "|", "space": " ", "whitespace": r"\s+",
}
EXTENSION_SEPARATORS = {".tsv": "\t", ".csv": ",", ".txt": "\t"}
DEFAULT_SEPARATOR = ","

LONG_COLUMNS = ("sample_ID", "data_type", "phenotype", "value", "occurrence_date")

# A run of control characters that text tables do not hold: read with it, a whole line is one column.
_WHOLE_LINE = "\x01\x02\x03\x02\x01"

# Takes the text of lines whose number of fields is not the header's.
_ODD_LINE = "\x02odd line\x02"

# What the parser makes room for; wide matrices have far more columns than its default of 20,480.
MAX_COLUMNS = 1_000_000


def resolve_separator(sep: str | None = None, path: str | None = None) -> tuple[str, bool]:
    """The separator and whether it is a regular expression."""
    if sep is None:
        extension = os.path.splitext(path or "")[1].lower()
        return EXTENSION_SEPARATORS.get(extension, DEFAULT_SEPARATOR), False
    name = sep.strip()
    if name in SEPARATOR_NAMES:
        found = SEPARATOR_NAMES[name]
    elif name in (r"\t", r"\s+"):
        found = {r"\t": "\t", r"\s+": r"\s+"}[name]
    else:
        found = sep
    return found, len(found) > 1


def scan_delimited(spark: SparkSession, path: str, sep: str | None = None,
                   multiline: bool = False) -> DataFrame:
    """Read a table with a header row; every column is a string, missing tokens are null.

    Nothing is lost in silence: a line with more fields than the header, and a file with another header than the first
    one, are errors; fields that a line lacks are null.

    `multiline` allows line breaks inside quoted fields, at the price of unsplittable files.
    """
    separator, is_regex = resolve_separator(sep, path)
    if is_regex:
        return normalize_nulls(_scan_by_regex(spark, path, separator))
    # A file whose header differs from the first one's is an error, not a swap of columns.
    options = dict(sep=separator, quote='"', escape='"')
    first = spark.read.csv(path, header=True, inferSchema=False, maxColumns=MAX_COLUMNS, multiLine=multiline, **options)
    if not first.columns:
        return first
    # Lines are told from one another by all their fields, so none is pruned by the parser.
    rows = spark.read.options(columnPruning=False).csv(path, T.StructType([*first.schema.fields, T.StructField(_ODD_LINE, T.StringType())]), header=True, enforceSchema=False,
                          maxColumns=MAX_COLUMNS, multiLine=multiline, mode="PERMISSIVE", columnNameOfCorruptRecord=_ODD_LINE, **options)
    # Lines with another number of fields come with their text; it is looked at again for a field beyond the header.
    wider = ", ".join(f"c{i} string" for i in range(len(first.columns) + 1))
    again = F.from_csv(_ODD_LINE, wider, {**options, "maxColumns": str(MAX_COLUMNS), "mode": "PERMISSIVE"})
    surplus = F.col(_ODD_LINE).isNotNull() & again.getField(f"c{len(first.columns)}").isNotNull()
    start = F.coalesce(F.col(quoted(first.columns[0])), F.lit(""))  # a filter on the line's text alone is not allowed
    refused = F.raise_error(F.concat(F.lit(f"more than {len(first.columns)} fields after '"), start, F.lit("': "), F.col(_ODD_LINE)))
    return normalize_nulls(rows.where(F.when(surplus, refused.cast("boolean")).otherwise(True)).drop(_ODD_LINE))


def _scan_by_regex(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    whole = dict(sep=_WHOLE_LINE, header=True, quote="", escape="")
    header = spark.read.csv(path, inferSchema=False, **whole).columns[0]
    lines = spark.read.csv(path, T.StructType([T.StructField(header, T.StringType())]), enforceSchema=False, **whole)
    line = F.col(quoted(header))
    if pattern == r"\s+":
        header, line = header.strip(), strip(line)
    names = spark.range(1).select(F.split(F.lit(header), pattern)).first()[0]
    fields = F.split(line, pattern)
    fields = F.when(F.size(fields) <= len(names), fields).otherwise(
        F.raise_error(F.concat(F.lit(f"more than {len(names)} fields: "), line)))
    return lines.select(*[F.get(fields, F.lit(i)).alias(name) for i, name in enumerate(names)])


def scan_long(spark: SparkSession, path: str, sep: str | None = None, format: str = "delimited") -> DataFrame:
    """A ready-made long table, taken as it is; absent canonical columns are added as nulls."""
    df = scan_delimited(spark, path, sep) if format == "delimited" else spark.read.format(format).load(path)
    for name in LONG_COLUMNS:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    rest = [c for c in df.columns if c not in LONG_COLUMNS]
    return df.select(*[quoted(c) for c in (*LONG_COLUMNS, *rest)])


def scan_roster(spark: SparkSession, path: str, sample_col: str = "sample_ID") -> DataFrame:
    """Sample identifiers, one per line: trimmed, blank lines dropped, each once."""
    lines = spark.read.text(path)
    return lines.select(strip(F.col("value")).alias(sample_col)).where(F.col(sample_col) != "").distinct()
