"""Run report of a long table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.values import as_number


def phenotype_report(long: DataFrame, columns: dict[str, list[str]] | None = None) -> DataFrame:
    """Per phenotype: rows, rows with a number, samples with data, and the columns it yields.

    Counted per (phenotype, sample) first, so a frequent phenotype is spread over its samples and
    no distinct set is kept.
    """
    rows = long.where(F.col("phenotype").isNotNull()).withColumn("_v", as_number(long, "value"))
    per_sample = rows.groupBy("data_type", "phenotype", "sample_ID").agg(
        F.count(F.lit(1)).alias("n"), F.count("_v").alias("n_numeric"))
    report = per_sample.groupBy("data_type", "phenotype").agg(
        F.sum("n").alias("n_rows"), F.sum("n_numeric").alias("n_numeric"), F.count("sample_ID").alias("n_samples"))
    if columns is None:
        return report
    shown = None
    for name, made in columns.items():
        test, text = F.col("phenotype") == name, F.lit(", ".join(made))
        shown = F.when(test, text) if shown is None else shown.when(test, text)
    return report.withColumn("columns", shown if shown is not None else F.lit(None).cast("string"))
