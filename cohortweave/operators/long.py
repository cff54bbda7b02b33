"""From raw tables to the canonical long table."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.functions.globs import has_glob, matches_any_glob
from cohortweave.runtime import local_table, quoted

# Text a null cell is compared as by the glob filter.
NULL_TEXT = "nan"


def glob_condition(df: DataFrame, patterns: dict[str, Iterable[str]] | None) -> Column:
    """Every named column matches one of its globs; unknown columns are skipped."""
    test = F.lit(True)
    for name, globs in (patterns or {}).items():
        if name not in df.columns:
            continue
        column = F.col(quoted(name))
        if not isinstance(df.schema[name].dataType, T.StringType):
            column = column.cast("string")
        test = test & matches_any_glob(column, globs, null_as=NULL_TEXT)
    return test


def glob_row_filter(df: DataFrame, patterns: dict[str, Iterable[str]] | None) -> DataFrame:
    return df.where(glob_condition(df, patterns))


def code_subsample(df: DataFrame, value_col: str, subsample: str | Iterable[str] = "all") -> DataFrame:
    """Keep rows with the wanted codes: 'all', exact codes, or globs when any entry is one."""
    if subsample == "all":
        return df
    wanted = [str(s) for s in subsample]
    column = F.col(quoted(value_col))
    if any(has_glob(s) for s in wanted):
        return df.where(matches_any_glob(column, wanted, null_as=NULL_TEXT))
    return df.where(column.isin(*wanted) if wanted else F.lit(False))


def sample_allow_list(df: DataFrame, allowed: DataFrame | Iterable[str] | None,
                      sample_col: str = "sample_ID") -> DataFrame:
    """Keep rows of the allowed samples. An empty list keeps nothing, no list keeps everything."""
    if allowed is None or sample_col not in df.columns:
        return df
    if not isinstance(allowed, DataFrame):
        import pyarrow as pa

        allowed = local_table(df.sparkSession, {"_allowed": [str(s) for s in allowed]}, {"_allowed": pa.string()})
    else:
        allowed = allowed.select(F.col(quoted(allowed.columns[0])).cast("string").alias("_allowed"))
    return df.join(allowed, F.col(quoted(sample_col)).cast("string") == F.col("_allowed"), "left_semi")


def resolve_reference_date(reference_date: str = "today", run_date: datetime.date | None = None) -> str:
    if reference_date != "today":
        return reference_date
    return (run_date or datetime.date.today()).isoformat()


def occurrence_date(df: DataFrame, date_col: str | None, reference_date: str = "today",
                    run_date: datetime.date | None = None) -> tuple[Column, Column]:
    """The date of each row and whether it was made up from the reference date."""
    reference = F.lit(resolve_reference_date(reference_date, run_date))
    if not date_col or date_col not in df.columns:
        return reference, F.lit(True)
    column = F.col(quoted(date_col))
    kind = df.schema[date_col].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        column, kind = column.cast("date"), T.DateType()
    return F.coalesce(column, reference.cast(kind)), column.isNull()


def fill_occurrence_date(df: DataFrame, date_col: str | None = None, reference_date: str = "today",
                         run_date: datetime.date | None = None) -> DataFrame:
    when, made_up = occurrence_date(df, date_col, reference_date, run_date)
    return df.withColumns({"occurrence_date": when, "date_is_synthetic": made_up})


def build_long(df: DataFrame, *, sample_id_col: str = "sample_ID", value_col: str, data_type: str,
               phenotype: str | None, date_col: str | None = None, reference_date: str = "today",
               run_date: datetime.date | None = None, mark_synthetic: bool = False) -> DataFrame:
    """Project a raw table to the long layout and drop rows without a value.

    `phenotype=None` makes each value its own phenotype, as for codes. Typed values and dates stay
    typed: the operators read both text and typed columns.
    """
    when, made_up = occurrence_date(df, date_col, reference_date, run_date)
    value = F.col(quoted(value_col))
    return df.where(value.isNotNull()).select(
        F.col(quoted(sample_id_col)).cast("string").alias("sample_ID"),
        F.lit(data_type).alias("data_type"),
        (value.cast("string") if phenotype is None else F.lit(phenotype)).alias("phenotype"),
        value.alias("value"),
        when.alias("occurrence_date"),
        *([made_up.alias("date_is_synthetic")] if mark_synthetic else []),
    )


def explode_codes(df: DataFrame, *, value_col: str, filters: dict | None = None,
                  allowed: DataFrame | Iterable[str] | None = None,
                  subsample: str | Iterable[str] = "all", **layout) -> DataFrame:
    """A coded table as long rows with one phenotype per code."""
    df = glob_row_filter(df, filters)
    df = sample_allow_list(df, allowed, layout.get("sample_id_col", "sample_ID"))
    df = code_subsample(df, value_col, subsample)
    return build_long(df, value_col=value_col, phenotype=None, data_type="coded", **layout)


def distinct_codes(df: DataFrame, value_col: str, filters: dict | None = None,
                   subsample: str | Iterable[str] = "all") -> DataFrame:
    """Codes left after filter and subsample; only the named columns are read."""
    df = code_subsample(glob_row_filter(df, filters), value_col, subsample)
    code = F.col(quoted(value_col))
    return df.where(code.isNotNull()).select(code.alias("code")).distinct()
