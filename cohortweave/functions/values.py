"""Text cleaning and typing of raw string columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.runtime import quoted

# Tokens read as missing in every input table.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# What counts as white space around codes, labels and identifiers.
WHITE_SPACE = " \t\n\r\x0b\x0c"

NUMERIC_TEXT = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"

# Layouts tried after ISO dates.
DATE_LAYOUTS = ("M/d/yyyy", "yyyyMMdd", "yyyy/M/d", "M-d-yyyy", "d-MMM-yyyy", "MMM d, yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yy",
                "d MMM yyyy", "MMMM d, yyyy", "MMM d yyyy", "yyyy/M/d H:mm", "yyyy/M/d H:mm:ss", "d-MMM-yy", "M/d/yyyy h:mm a")


def strip(column: Column) -> Column:
    return F.btrim(column, F.lit(WHITE_SPACE))


def null_if_missing(column: Column) -> Column:
    return F.when(~column.isin(*NA_TOKENS), column)


def normalize_nulls(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Turn every missing-value token of the string columns into null."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(*[
        null_if_missing(F.col(quoted(f.name))).alias(f.name)
        if f.name in wanted and isinstance(f.dataType, T.StringType)
        else F.col(quoted(f.name))
        for f in df.schema.fields
    ])


def as_number(df: DataFrame, name: str) -> Column:
    """Column `name` as double; text that is not a plain number, and NaN, become null."""
    column = F.col(quoted(name))
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        # The pattern keeps out Java-only spellings such as '1d' or hexadecimal floats.
        column = F.when(column.rlike(NUMERIC_TEXT), column.try_cast("double"))
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        column = column.cast("double")
        column = F.when(~F.isnan(column), column)
    else:
        column = column.cast("double")
    return column


def as_date(df: DataFrame, name: str, layouts: Iterable[str] = DATE_LAYOUTS) -> Column:
    """Column `name` as date; text that is neither an ISO date nor in one of the `layouts` becomes null."""
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, T.StringType):
        text = strip(column)
        return F.coalesce(text.try_cast("date"), *[F.try_to_date(text, layout) for layout in layouts])
    return column.cast("date")


def unreadable_dates(df: DataFrame, names: Iterable[str], layouts: Iterable[str] = DATE_LAYOUTS) -> DataFrame:
    """One row: for each column how many texts are there but cannot be read as a date."""
    layouts = list(layouts)
    return df.agg(*[F.count(F.when(F.col(quoted(n)).isNotNull() & as_date(df, n, layouts).isNull(), 1)).alias(n) for n in names])


def coerce_numeric(df: DataFrame, value_col: str = "value", output_col: str = "value_num") -> DataFrame:
    return df.withColumn(output_col, as_number(df, value_col))
