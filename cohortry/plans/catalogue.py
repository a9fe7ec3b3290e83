"""All registered queries of the library; importing a module of queries registers them."""

from cohortry.plans import file_queries, interval_queries, matrix_queries, model_queries, quality_queries, record_queries, text_queries  # noqa: F401
from cohortry.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
