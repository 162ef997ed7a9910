"""Queries over the test tables, each with the SQL that gives the same result."""

from terrace_queries import cleaning, ingest, layers  # noqa: F401  (they fill the registry)
from terrace_queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
