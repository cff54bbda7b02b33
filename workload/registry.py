"""All registered queries."""

from workload import (  # noqa: F401  (registered on import)
    categories, cleaning, codes, cohort, gathering, masking, quantitative, raw_tables, risk)
from workload.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
