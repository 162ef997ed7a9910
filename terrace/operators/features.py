"""Features per entity.

A strategy is a list of aggregate columns, so that all strategies on one table share one scan and
one shuffle. Spark combines the aggregates in each task first, so an entity with a third of the rows
does not land in one task. Distinct values in nested ranges of time are counted from the latest time of
each value, an aggregation of its own, instead of multiplying the rows by the ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import column, unused_name
from terrace.operators.base import require_columns
from terrace.operators.frequent import FrequentCategories


@dataclass(frozen=True)
class TimeWindows:
    """Features over ranges of time that all end at the same instant."""

    aggregates: Sequence[Column]
    time: Column
    end: Column
    days: Sequence[int]
    distinct: Sequence[str] = ()
    recent_only: bool = False

    def start(self, days: int) -> Column:
        return self.end - F.make_dt_interval(F.lit(days))

    def distinct_counts(self, df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        """How many values of a column each entity has in each range: those whose latest time is in it."""
        latest, key = unused_name(df, "latest"), [column(k) for k in keys]
        values = df.groupBy(*key, column(name)).agg(F.max(F.when(self.time <= self.end, self.time)).alias(latest))
        inside = {n: column(name).isNotNull() & (column(latest) > self.start(n)) for n in self.days}
        return values.groupBy(*key).agg(*[F.count_if(inside[n]).alias(f"{name}_count_distinct_{n}d") for n in self.days])


Strategy = Sequence[Column] | TimeWindows | FrequentCategories

AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "count": F.count,
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "count_distinct": F.count_distinct,
}


def _aggregate(name: str) -> Callable[[Column], Column]:
    if name not in AGGREGATES:
        raise ValueError(f"unknown aggregate '{name}': use one of {', '.join(AGGREGATES)}")
    return AGGREGATES[name]


def entity_aggregates(columns: Mapping[str, Sequence[str]], rows: str | None = "rows") -> Strategy:
    """``{column: [aggregate, ...]}`` to features ``column_aggregate``, and the number of rows."""
    features = [F.count(F.lit(1)).alias(rows)] if rows else []
    return features + [_aggregate(a)(column(c)).alias(f"{c}_{a}") for c, names in columns.items() for a in names]


def time_window_aggregates(
    time: str,
    as_of: datetime | str,
    days: Sequence[int],
    columns: Mapping[str, Sequence[str]],
    rows: str = "rows",
    recent_only: bool = False,
) -> Strategy:
    """The same over the last 1, 7, 30 ... days up to and including ``as_of``.

    An entity with nothing in them has a row too, for which the whole history is read. With ``recent_only`` the
    rows that are in the longest range are all that is read, and entities without any are left out.
    """
    end = F.lit(str(as_of)).cast("timestamp_ntz")
    at = column(time).cast("timestamp_ntz")
    windows = TimeWindows((), at, end, tuple(days), recent_only=recent_only)
    features = []
    for n in days:
        inside = (at > windows.start(n)) & (at <= end)
        features.append(F.count_if(inside).alias(f"{rows}_{n}d"))
        for c, names in columns.items():
            plain = [a for a in names if a != "count_distinct"]
            features += [_aggregate(a)(F.when(inside, column(c))).alias(f"{c}_{a}_{n}d") for a in plain]
    distinct = tuple(c for c, names in columns.items() if "count_distinct" in names)
    return replace(windows, aggregates=tuple(features), distinct=distinct)


def category_counts(category: str, values: Sequence[Any]) -> Strategy:
    """How often each listed value occurs, as features ``category_value``."""
    return [F.count_if(column(category) == F.lit(v)).alias(f"{category}_{v}") for v in values]


STRATEGIES: dict[str, Callable[..., Strategy]] = {
    "entity_aggregates": entity_aggregates,
    "time_window_aggregates": time_window_aggregates,
    "category_counts": category_counts,
    "frequent_categories": FrequentCategories,
}


def register_strategy(name: str, build: Callable[..., Strategy]) -> None:
    """Add a strategy: a function that gives aliased aggregate columns."""
    STRATEGIES[name] = build


def strategy(spec: Mapping[str, Any] | Strategy) -> Strategy:
    """``{"strategy": name, ...arguments}`` to its columns; columns pass through."""
    if not isinstance(spec, Mapping):
        return spec  # columns or time windows
    arguments = dict(spec)
    name = arguments.pop("strategy", None)
    if name not in STRATEGIES:
        raise ValueError(f"unknown strategy '{name}': use one of {', '.join(STRATEGIES)}")
    return STRATEGIES[name](**arguments)


def _distinct_names(problem: str, names: Sequence[str]) -> None:
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"{problem}: {', '.join(twice)}")


def build_features(df: DataFrame, keys: Sequence[str], strategies: Sequence[Strategy]) -> DataFrame:
    """One row per entity, with the features of all strategies.

    Time windows that are ``recent_only`` read the table by themselves, so that their filter reaches the scan; what
    they leave out has null features beside other strategies.
    """
    require_columns(df, keys)
    strategies = [s.resolved(df) if isinstance(s, FrequentCategories) else s for s in strategies]
    windows = [s for s in strategies if isinstance(s, TimeWindows)]
    shared = [f for s in strategies if not isinstance(s, TimeWindows) for f in s]
    shared += [f for w in windows if not w.recent_only for f in w.aggregates]
    by = [column(k) for k in keys]
    parts = [df.groupBy(*by).agg(*shared)] if shared else []
    for w in windows:
        rows = df.where((w.time > w.start(max(w.days))) & (w.time <= w.end)) if w.recent_only else df
        parts += [rows.groupBy(*by).agg(*w.aggregates)] if w.recent_only else []
        parts += [w.distinct_counts(rows, keys, c) for c in w.distinct]
    for part in parts:
        _distinct_names("feature named twice", part.columns)
    return join_features(parts, keys)


def join_features(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Put feature tables side by side: a full outer join in which a null key equals a null key.

    Written as a union and one aggregation: a single shuffle of rows that are already one per
    entity, where a chain of outer joins would shuffle again for each part.
    """
    if len(parts) == 1:
        return parts[0]
    features = [n for p in parts for n in p.columns if n not in keys]
    _distinct_names("feature in more than one part", features)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy(*[column(k) for k in keys]).agg(
        *[F.first(column(n), ignorenulls=True).alias(n) for n in features]
    )
