"""Column-level building blocks shared by the operators."""

from terrace.functions.columns import column, is_missing, quote, quote_table, sql_text, unused_name, without_nan
from terrace.functions.text import delimiter_pattern, normalized_text, parsed_timestamp, split_by_position

__all__ = [
    "column",
    "delimiter_pattern",
    "is_missing",
    "normalized_text",
    "parsed_timestamp",
    "quote",
    "quote_table",
    "split_by_position",
    "sql_text",
    "unused_name",
    "without_nan",
]
