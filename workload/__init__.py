"""Registered queries on the given tables, each with the SQL its result is checked against."""
