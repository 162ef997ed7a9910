"""Steps that remove rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.ml.param import Param, Params
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from terrace.contract import HOW, as_list, ordering
from terrace.functions import column, is_missing, unused_name
from terrace.operators.base import Step


def _sort_column(entry: str) -> Column:
    name, descending = ordering(entry)
    return column(name).desc() if descending else column(name).asc()


class RemoveDuplicates(Step):
    """One row of each group of equal rows, or of each group of equal keys (``subset_cols``).

    Both forms combine before the shuffle, so a value held by a third of the rows sends one row per
    task. Which row of a key stays is arbitrary, unless ``order_by`` names the first one.

    A stream needs ``time``, a timestamp column, and ``within``, such as ``7 days``: keys are remembered until the stream
    is that far past the time of their first row, and a row that comes then with an earlier time than that is dropped,
    duplicate or not (``append_new`` counts these). Of duplicates the one that comes first stays. A row without a time
    is let through, as nothing tells how long to remember it. Tables are deduplicated whole all the same.
    """

    section_name = "remove_duplicates"

    time: Param = Param(Params._dummy(), "time", "on streams: the column that tells when a row is from")
    within: Param = Param(Params._dummy(), "within", "on streams: how long a key is remembered")

    def __init__(
        self,
        contract: Mapping[str, Any] | None = None,
        on_error: str = "null",
        time: str | None = None,
        within: str | None = None,
    ):
        super().__init__(contract, on_error)
        if bool(time) != bool(within):
            raise ValueError("a stream needs both time and within to tell how long a key is remembered")
        self._set(time=time or "", within=within or "")

    def _lists(self) -> tuple[list[str], list[str]]:
        rules = self.rules or {}
        return as_list(rules.get("subset_cols")), as_list(rules.get("order_by"))

    def input_columns(self) -> list[str]:
        keys, order = self._lists()
        time = self.getOrDefault("time")
        return keys + [ordering(o)[0] for o in order] + ([time] if time else [])

    def _on_stream(self, df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        time, within = self.getOrDefault("time"), self.getOrDefault("within")
        if not time:
            raise ValueError("a stream would have to remember every row it has seen: name time and within, or deduplicate the table")
        if order:
            raise ValueError("on a stream the row that comes first stays: order_by is for tables")
        if not isinstance(df.schema[time].dataType, (TimestampType, TimestampNTZType)):
            raise ValueError(f"column '{time}' is {df.schema[time].dataType.simpleString()}: convert it to a timestamp first")
        clock = unused_name(df, "clock")
        # A key of their own for each row without a time: they are no duplicates of one another.
        own = unused_name(df, "own")
        timed = df.withColumn(clock, column(time).cast("timestamp")).withColumn(
            own, F.when(column(time).isNull(), F.expr("uuid()"))
        )
        told = timed.withWatermark(clock, within).dropDuplicatesWithinWatermark([*(keys or df.columns), own])
        return told.drop(clock, own)

    def apply(self, df: DataFrame) -> DataFrame:
        keys, order = self._lists()
        if df.isStreaming:
            return self._on_stream(df, keys, order)
        if not keys:
            return df.dropDuplicates()
        if not order:
            return df.dropDuplicates(keys)
        # `= 1` on a row number lets Spark keep one row per key in each task before the shuffle
        # (WindowGroupLimit), so a hot key is never collected whole.
        first = Window.partitionBy(*[column(k) for k in keys]).orderBy(*[_sort_column(o) for o in order])
        position = unused_name(df, "position")
        return df.withColumn(position, F.row_number().over(first)).where(column(position) == 1).drop(position)


class RemoveNulls(Step):
    """Drop rows where any, or all, of the chosen columns are null. NaN counts as null."""

    section_name = "remove_nulls"

    def input_columns(self) -> list[str]:
        return as_list((self.rules or {}).get("subset_cols"))

    def apply(self, df: DataFrame) -> DataFrame:
        how = (self.rules or {}).get("how") or "any"
        if how not in HOW:
            raise ValueError(f"how must be any or all, not '{how}'")
        names = self.input_columns() or df.columns
        present = [~is_missing(n, df.schema[n].dataType) for n in names]
        return df.where(reduce(and_ if how == "any" else or_, present)) if present else df
