"""Splitting a cohort into chunks of whole samples."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortweave.runtime import local_table, quoted, settle


def cohort_chunks(long: DataFrame, chunk_size: int, sample_col: str = "sample_ID") -> DataFrame:
    """Rows with a `chunk_id`: samples in sorted order, `chunk_size` per chunk, zero-padded ids.

    The global rank of a sample is its rank inside a sorted range of samples plus the sizes of the
    ranges before it. The ranges are settled first, so that both steps see the same cut points.
    """
    if chunk_size < 1:
        raise ValueError(f"chunk_size must be at least 1, not {chunk_size}")
    if sample_col not in long.columns:
        raise ValueError(f"no column {sample_col!r}; there are {long.columns}")
    sample = F.col(quoted(sample_col))
    ranges = settle(
        long.where(sample.isNotNull()).select(sample.alias("_sample")).distinct()
        .repartitionByRange("_sample").withColumn("_range", F.spark_partition_id()))

    # One row per range of samples, never more than there are partitions.
    sizes = {r["_range"]: r["count"] for r in ranges.groupBy("_range").count().collect()}
    before, total = {}, 0
    for i in sorted(sizes):
        before[i] = total
        total += sizes[i]
    width = len(str(max(1, -(-total // chunk_size))))
    offsets = local_table(long.sparkSession, {"_range": list(before), "_before": list(before.values())},
                          {"_range": pa.int32(), "_before": pa.int64()})

    rank = F.row_number().over(W.partitionBy("_range").orderBy("_sample")) + F.col("_before") - 1
    chunk = (F.floor(rank / chunk_size) + 1).cast("string")
    chunks = ranges.join(offsets, "_range").select("_sample", F.lpad(chunk, width, "0").alias("chunk_id"))
    return long.join(chunks, sample == F.col("_sample")).drop("_sample")
