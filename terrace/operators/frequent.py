"""Categories that nobody lists: the values that make up a share of a table, and how often each entity has them."""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import column
from terrace.operators.base import require_columns

# A sketch's error is 3.5 in so many places; values of twice the error are sure to be found.
PLACES = 8
# A task merges the sketches of so many others at most.
MERGED = 1024


def _candidates(df: DataFrame, category: str, share: float) -> list[Any]:
    """At most ``PLACES / share`` values, all that make up ``share`` of the rows among them.

    Every task keeps a sketch of frequent values, whose size goes with ``1 / share`` and not with the values there are;
    the sketches of ``MERGED`` neighbouring tasks are merged first, and then what these merges give.
    """
    places = math.ceil(PLACES / share)
    near = df.groupBy(F.floor(F.spark_partition_id() / MERGED).alias("group"))
    sketches = near.agg(F.call_function("approx_top_k_accumulate", column(category), F.lit(places)).alias("sketch"))
    merged = sketches.agg(F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(places)).alias("sketch"))
    (found,) = merged.select(F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(places)).alias("top")).first()
    return [row["item"] for row in found]


def frequent_values(df: DataFrame, category: str, share: float) -> list[Any]:
    """The values of a column that at least ``share`` of its non-null rows have, most frequent first, ties by value.

    Candidates come from sketches; only they are then counted exactly, so that no task sees all values that there are.
    There are at most ``1 / share``. A column without values has none.
    """
    require_columns(df, [category])
    if not 0.0001 <= share <= 1:
        raise ValueError("the share is one ten-thousandth at least and 1 at most")
    rows = df.where(column(category).isNotNull()).select(column(category))
    candidates = _candidates(rows, category, share) if not rows.isEmpty() else []
    kept = F.when(column(category).isin(candidates), column(category)) if candidates else F.lit(None)
    counts = {r[0]: r[1] for r in rows.groupBy(kept.alias("value")).count().collect()}
    total = sum(counts.values())
    often = [(n, v) for v, n in counts.items() if v is not None and n >= share * total]
    return [v for n, v in sorted(often, key=lambda c: (-c[0], c[1]))]


@dataclass(frozen=True)
class FrequentCategories:
    """How often an entity has each value that makes up ``share`` of the table, as features ``category_value``, and any
    other value, as ``category_other`` (named by ``rest``). Nulls are not counted. The values are looked up when the
    features are built, and so go with the table: name them by ``category_counts`` where columns must not change."""

    category: str
    share: float
    rest: str | None = "other"

    def resolved(self, df: DataFrame) -> list[Column]:
        values, c = frequent_values(df, self.category, self.share), column(self.category)
        features = [F.count_if(c == F.lit(v)).alias(f"{self.category}_{v}") for v in values]
        if self.rest:
            others = c.isNotNull() & ~c.isin(values) if values else c.isNotNull()
            features.append(F.count_if(others).alias(f"{self.category}_{self.rest}"))
        return features
