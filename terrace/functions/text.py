"""Text and timestamp expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.columns import column

# Fixed value: the pattern a timestamp column has when the contract names none.
DEFAULT_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def normalized_text(c: Column) -> Column:
    """Without outer spaces, in lower case. Tabs and inner spaces stay."""
    return F.lower(F.trim(c))


def parsed_timestamp(c: Column, fmt: str = DEFAULT_TIMESTAMP_FORMAT, on_error: str = "null") -> Column:
    """Text to timestamp by pattern; text that does not fit becomes null or fails the job."""
    return F.to_timestamp(c, fmt) if on_error == "fail" else F.try_to_timestamp(c, F.lit(fmt))


def delimiter_pattern(delimiter: str, is_regex: bool = False) -> str:
    """The ``split`` pattern for a delimiter, which is taken literally unless ``is_regex``."""
    if is_regex:
        return delimiter
    return "\\Q" + delimiter.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_by_position(
    df: DataFrame,
    names: Sequence[str],
    delimiter: str,
    is_regex: bool = False,
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Split ``value`` and name piece i by the i-th name: missing pieces are null, extra ones dropped.

    Of other columns only those to ``keep`` stay.
    """
    kept = [column(n) for n in keep]
    pieces = df.select(F.split(column(value), delimiter_pattern(delimiter, is_regex)).alias("pieces"), *kept)
    return pieces.select(*[F.get("pieces", F.lit(i)).alias(n) for i, n in enumerate(names)], *kept)
