"""Writers for long tables, wide matrices and sample chunks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.runtime import listing_in_few_tasks, quoted

# Range keys after the leading one, so that equal leading keys can be spread.
_ROW_KEYS = ("sample_ID", "occurrence_date", "value")


def _save(df: DataFrame, path: str, format: str, mode: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "tsv":
        # The writer would trim text by default.
        writer.csv(path, sep="\t", header=True, quote='"', escape='"',
                   ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    else:
        writer.format(format).save(path)


def write_long(df: DataFrame, path: str, format: str = "parquet", mode: str = "errorifexists") -> None:
    """Write a long table clustered by phenotype.

    Ranges keep the rows of one phenotype in few files, so that a reader of one code skips the
    others by min/max statistics. The later keys of the range let a phenotype, or a single sample,
    with a large share of all rows spread over many files instead of landing in one task.
    """
    keys = [c for c in ("phenotype", *_ROW_KEYS) if c in df.columns]
    clustered = df.repartitionByRange(*keys).sortWithinPartitions(*keys[:2])
    _save(clustered, path, format, mode)


def write_long_buckets(df: DataFrame, name: str, path: str, buckets: int, spread: int = 4) -> DataFrame:
    """Write a long table as the catalogue table `name`, in buckets by sample; returns it as reread.

    Per-sample aggregations and joins of tables with equal buckets then need no exchange. Each bucket is written by
    up to `spread` tasks, dealt by the other columns, so that a sample with a large share of all rows is not
    written by one; a table has at most `buckets` * `spread` files. A reader takes a bucket per task, so `buckets` should
    grow with the data (some 200 MB each). Rows without a sample are kept. An existing table of that name is an error.
    """
    others = [F.col(quoted(f.name)) for f in df.schema.fields if f.name != "sample_ID" and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salt = F.pmod(F.xxhash64(*others), F.lit(spread)) if others else F.lit(0)
    dealt = df.repartition(buckets * spread, F.pmod(F.hash("sample_ID"), F.lit(buckets)), salt)
    dealt.write.format("parquet").option("path", path).bucketBy(buckets, "sample_ID").saveAsTable(name)
    return df.sparkSession.table(name)


def write_wide(df: DataFrame, path: str, format: str = "tsv", mode: str = "errorifexists") -> None:
    _save(df, path, format, mode)


def write_chunks(df: DataFrame, path: str, format: str = "tsv", mode: str = "errorifexists") -> None:
    """One folder per `chunk_id` of `cohort_chunks`; each task writes few chunks, a large chunk has many files."""
    keys = [c for c in ("chunk_id", *_ROW_KEYS) if c in df.columns]
    _save(df.repartitionByRange(*keys), path, format, mode, ["chunk_id"])


def read_chunks(spark: SparkSession, path: str, schema: T.StructType, chunks: Iterable[str] | None = None) -> DataFrame:
    """Chunks written by `write_chunks` as Parquet; of named ones only their folders are read.

    `schema` is that of the written table. Chunk ids stay text: `007` is no number.
    """
    with listing_in_few_tasks(spark):
        df = spark.read.schema(schema).parquet(path)
    return df if chunks is None else df.where(F.col("chunk_id").isin(*chunks))
