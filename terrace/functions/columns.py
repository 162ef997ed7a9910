"""Naming and null helpers for columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def quote(name: str) -> str:
    """Back-tick an identifier, so that dots and spaces in it are literal."""
    return "`" + name.replace("`", "``") + "`"


def quote_table(table: str) -> str:
    """Back-tick each part of ``table``, ``db.table`` or ``catalog.db.table``."""
    parts = table.split(".")
    if not 1 <= len(parts) <= 3 or not all(parts):
        raise ValueError(f"'{table}' is not a table name of one to three parts")
    return ".".join(quote(p) for p in parts)


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column(name: str) -> Column:
    """The top-level column called exactly ``name``."""
    return F.col(quote(name))


def is_fractional(dtype: DataType) -> bool:
    return isinstance(dtype, (DoubleType, FloatType))


def without_nan(name: str, dtype: DataType) -> Column:
    """The column with NaN turned into null; other types are untouched."""
    c = column(name)
    return F.nanvl(c, F.lit(None).cast(dtype)) if is_fractional(dtype) else c


def is_missing(name: str, dtype: DataType) -> Column:
    """True for null, and for NaN in a float or double column.

    Written as ``IS NULL`` rather than through ``dropna``: a filter on its negation reaches the
    Parquet scan as ``IsNotNull``, which ``dropna``'s own expression does not.
    """
    c = column(name)
    return c.isNull() | F.isnan(c) if is_fractional(dtype) else c.isNull()


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, or that with a number after it: one the table has no column of, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    return next(n for i in range(len(taken) + 1) if (n := f"{name}{i or ''}").lower() not in taken)
