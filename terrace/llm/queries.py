"""All queries of the operators, and their SQL."""

from terrace.llm import query_chat, query_classifiers, query_contamination, query_extraction, query_near_copies, query_odd_sketches, query_packing, query_rules, query_runs, query_spelling, query_urls, query_warc  # noqa: F401  (it fills the registry)
from terrace.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
