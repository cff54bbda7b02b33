"""Date arithmetic on demographics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.values import as_date


def whole_years(born: Column, on: Column) -> Column:
    """Completed years between two dates; a 29 February birthday is reached on 1 March."""
    day_of_year = lambda d: F.struct(F.month(d), F.dayofmonth(d))
    years = F.year(on) - F.year(born)
    return F.when(day_of_year(on) >= day_of_year(born), years).otherwise(years - 1)


def age_at_reference(df: DataFrame, birth_col: str, ref_date: str, output_col: str = "age") -> DataFrame:
    return df.withColumn(output_col, whole_years(as_date(df, birth_col), F.lit(ref_date).cast("date")))
