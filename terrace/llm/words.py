"""Words of texts, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and no other letter; the faster ``lower`` does so where a text has no others."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_words(text: Column, separators: str) -> Column:
    """What stands between runs of a class of characters, in order; none for null."""
    return F.coalesce(F.array_remove(F.split(text, f"[{separators}]+"), ""), F.array().cast("array<string>"))
