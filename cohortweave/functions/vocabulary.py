"""Vocabulary labels: alias normalisation and detection from values and column names."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.values import NUMERIC_TEXT, strip
from cohortweave.runtime import local_table, quoted

# Accepted spellings of each canonical data type.
DATA_TYPE_ALIASES = {
    "ICD9": ("ICD09", "ICD-9", "ICD9CM", "ICD-9-CM", "icd9", "icd09", "icd-9", "ICD_9"),
    "ICD10": ("ICD-10", "ICD10CM", "ICD-10-CM", "icd10", "icd-10", "ICD_10"),
    "SNOMED": ("SNOMED_CT", "snomedct", "snomed"),
    "quantitative": ("Quantitative", "QUANT", "quant"),
    "categorical": ("Categorical", "CAT"),
    "binary": ("Binary", "BINARY"),
    "demographic": ("Demo", "DEMO", "Demographics"),
    "vitals": ("Vital", "VITAL"),
    "drugs": ("Drug", "DRUG", "Medication", "MEDICATION"),
    "measurements": ("Lab", "LAB", "Laboratory", "Measurement"),
}

# Which labels each phenotype family takes in.
QUANTITATIVE_LABELS = ("quantitative", "measurements", "vitals")
CATEGORICAL_LABELS = ("categorical", "survey", "demographic", "demographics")

# Shapes of ICD codes and column names, and the detection thresholds.
ICD10_VALUE = r"^[A-Z][0-9]{2}"
ICD9_VALUE = r"^[0-9]{3,5}(\.[0-9]+)?$"
ICD10_NAME = r"(?i)^[A-Z][0-9]{2}"
ICD9_NAME = r"^[0-9]{3}"
MAJORITY = 0.7


def normalize_data_type(label: Column) -> Column:
    """Canonical label for an alias; anything else is only trimmed."""
    label = strip(label)
    out = None
    for canonical, spellings in DATA_TYPE_ALIASES.items():
        test = label.isin(*spellings)
        out = F.when(test, F.lit(canonical)) if out is None else out.when(test, F.lit(canonical))
    return out.otherwise(label)


def in_family(label: Column, family: str) -> Column:
    labels = {"quantitative": QUANTITATIVE_LABELS, "categorical": CATEGORICAL_LABELS}[family]
    return F.lower(label).isin(*labels)


def route_by_data_type(long: DataFrame, family: str) -> DataFrame:
    """Rows of one phenotype family; a table without `data_type` belongs to it as a whole."""
    if "data_type" not in long.columns:
        return long
    return long.where(in_family(F.col("data_type"), family))


def detect_column_type(name: Column) -> Column:
    """Data type suggested by a column name, or null."""
    upper = F.upper(name)

    def has(*words):
        test = upper.contains(words[0])
        for word in words[1:]:
            test = test | upper.contains(word)
        return test

    return (
        F.when(has("ICD9", "ICD09"), "ICD9")
        .when(has("ICD10", "ICD-10"), "ICD10")
        .when(has("SNOMED"), "SNOMED")
        .when(has("BMI", "HEIGHT", "WEIGHT"), "quantitative")
        .when(has("SEX", "GENDER", "ANCESTRY", "RACE"), "demographic")
        .when(name.rlike(ICD10_NAME), "ICD10")
        .when(name.rlike(ICD9_NAME), "ICD9")
    )


def _share(value: Column, pattern: str) -> Column:
    return F.avg(F.when(value.isNotNull(), value.rlike(pattern).cast("int")))


def detect_value_type(df: DataFrame, columns: list[str]) -> DataFrame:
    """Data type suggested by all non-null values of each column: (column, n_values, value_type)."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("text")) for c in columns
    ]))
    # a row without a value per column, so that an empty table has them too
    every = local_table(df.sparkSession, {"column": columns, "text": [None] * len(columns)}, {"column": pa.string(), "text": pa.string()})
    cells = df.select(pairs.alias("_cell")).select("_cell.*").union(every)
    text = F.col("text")
    shares = cells.groupBy("column").agg(
        F.count(text).alias("n_values"),
        _share(text, ICD10_VALUE).alias("icd10"),
        _share(text, ICD9_VALUE).alias("icd9"),
        F.min(F.when(text.isNotNull(), text.rlike(NUMERIC_TEXT))).alias("numeric"),
    )
    kind = (
        F.when(F.col("n_values") == 0, "unknown")
        .when(F.col("icd10") > MAJORITY, "ICD10")
        .when(F.col("icd9") > MAJORITY, "ICD9")
        .when(F.col("numeric"), "quantitative")
        .otherwise("categorical")
    )
    return shares.select("column", "n_values", kind.alias("value_type"))


def profile_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: what its name and its values suggest."""
    found = detect_value_type(df, columns or df.columns)
    return found.withColumn("name_type", detect_column_type(F.col("column")))
