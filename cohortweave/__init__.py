"""Cohort phenotyping on Spark: raw clinical tables in, one row per sample out."""
