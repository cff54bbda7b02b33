"""Bringing per-phenotype tables together."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.runtime import quoted

log = logging.getLogger(__name__)


def _usable(tables: Sequence[DataFrame], sample_col: str) -> list[DataFrame]:
    if not tables:
        log.warning("gather: no tables given")
        return []
    usable = [t for t in tables if sample_col in t.columns]
    if len(usable) < len(tables):
        log.warning("gather: %d tables without %s skipped", len(tables) - len(usable), sample_col)
    if not usable:
        raise ValueError(f"no table has a {sample_col} column")
    return usable


def _stacked(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of equal schemas as a tree, so that the plan of hundreds of tables stays shallow."""
    tables = list(tables)
    while len(tables) > 1:
        tables = [a.union(b) for a, b in zip(tables[::2], tables[1::2])] + tables[len(tables) & ~1:]
    return tables[0]


def gather_wide(tables: Sequence[DataFrame], sample_col: str = "sample_ID", sort: bool = True) -> DataFrame | None:
    """Full outer join of all tables on the sample, as one union and one exchange.

    Each table gives its row as (number of the table, an array of cells per data type), so the plan grows with the columns
    and not with tables times columns. A sample has one such row per table, merged into one map from which the
    columns are read. A column name used twice, or a sample with two rows in a table, is an error; rows
    are counted with a state of fixed size, however often a sample is repeated.
    """
    tables = _usable(tables, sample_col)
    if not tables:
        return None
    columns = [c for t in tables for c in t.columns if c != sample_col]
    repeated = sorted({c for c in columns if columns.count(c) > 1})
    if repeated:
        raise ValueError(f"columns produced by more than one table: {repeated}")

    held = [[(f.name, f.dataType) for f in t.schema.fields if f.name != sample_col] for t in tables]
    kinds = []
    for kind in (kind for cells in held for _, kind in cells):
        if kind not in kinds:
            kinds.append(kind)
    arrays = [f"_a{k}" for k in range(len(kinds))]
    absent = [F.lit(None).cast(T.ArrayType(kind)).alias(a) for kind, a in zip(kinds, arrays)]
    parts, places = [], []
    for i, (table, cells) in enumerate(zip(tables, held)):
        of_kind = [[name for name, kind in cells if kind == k] for k in kinds]
        parts.append(table.select(F.col(quoted(sample_col)).alias("_sample"), F.lit(i).alias("_table"), *[
            F.expr(f"array({', '.join(map(quoted, names))}) AS {a}") if names else none
            for names, a, none in zip(of_kind, arrays, absent)]))
        for name, kind in cells:
            k = kinds.index(kind)
            places.append(f"_t{i}.{arrays[k]}[{of_kind[k].index(name)}] AS {quoted(name)}")

    # Dealt by sample alone: both groupings below then need no exchange of their own.
    rows = _stacked(parts).where("_sample IS NOT NULL").repartition("_sample").groupBy("_sample", "_table").agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(True).alias("_here"), *arrays)).alias("_cells"))
    checked = F.when(F.col("_n") == 1, F.col("_cells")).otherwise(F.raise_error(
        F.concat(F.lit("sample with several rows in one table: "), F.col("_sample").cast("string"))))
    merged = rows.groupBy("_sample").agg(F.map_from_entries(F.collect_list(F.struct("_table", checked.alias("_cells")))).alias("_of"))
    merged = merged.selectExpr("_sample", *[f"_of[{i}] AS _t{i}" for i in range(len(tables))])
    wide = merged.selectExpr(f"_sample AS {quoted(sample_col)}", *places)
    return wide.orderBy(quoted(sample_col)) if sort else wide


def _text(name: str) -> str:
    """`name` as a string literal."""
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _cells(table: DataFrame, sample_col: str) -> DataFrame:
    # one expression in text: building columns one by one takes longer than planning them
    pairs = ", ".join(f"named_struct('phenotype', {_text(c)}, 'value', CAST({quoted(c)} AS STRING))" for c in table.columns if c != sample_col)
    return table.selectExpr(quoted(sample_col), f"inline(array({pairs}))")


def gather_long(tables: Sequence[DataFrame], sample_col: str = "sample_ID", sort: bool = True) -> DataFrame | None:
    """(sample, phenotype, value) of all tables; only cells a table has itself, nulls included."""
    tables = [t for t in _usable(tables, sample_col) if len(t.columns) > 1]
    if not tables:
        return None
    out = _stacked([_cells(t, sample_col) for t in tables])
    return out.orderBy(sample_col, "phenotype") if sort else out


def gather_both(tables: Sequence[DataFrame], sample_col: str = "sample_ID",
                sort: bool = True) -> tuple[DataFrame | None, DataFrame | None]:
    return gather_wide(tables, sample_col, sort), gather_long(tables, sample_col, sort)


def union_wide(parts: Sequence[DataFrame], sort_by: str = "sample_ID", no_sort: bool = False) -> DataFrame:
    """Stack wide parts by column name; a column a part lacks is null there."""
    if not parts:
        raise ValueError("no parts given")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out if no_sort or sort_by not in out.columns else out.orderBy(quoted(sort_by))


def pivot_long(long: DataFrame, names: Sequence[str], sample_col: str = "sample_ID") -> DataFrame:
    """(sample, phenotype, value) as columns for a known list of phenotypes."""
    return long.groupBy(sample_col).pivot("phenotype", list(names)).agg(F.max("value"))
