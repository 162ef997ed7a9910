"""Exact medians of columns too large to sort in one task."""

from __future__ import annotations

import decimal
import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

from terrace.functions import column, without_nan
from terrace.scratch import remove, scratch_path

# Rank error 1/1000 of what is left in a pass of ``exact_medians``.
ACCURACY = 1_000
# Most values of one column that the last pass brings together in a task.
FEW = 10_000


@dataclass
class _Bracket:
    """The open interval the median lies in: it is the ``rank``-th smallest of ``rows`` values there."""

    above: Any = None
    below: Any = None
    rank: int = 0
    rows: int = 0
    found: Any = None

    def values(self, v: Column) -> Column:
        """``v`` where it lies inside, else null."""
        inside = F.lit(True)
        if self.above is not None:
            inside &= v > F.lit(self.above)
        if self.below is not None:
            inside &= v < F.lit(self.below)
        return F.when(inside, v)

    def narrow(self, pivots: Sequence[Any], counts: Sequence[tuple[int, int]]) -> None:
        """Move both ends to the pivots next to the median, given for each how many are ``<`` and ``<=``.

        Pivots are values that rows hold, so that each pass leaves fewer rows.
        """
        rank, rows, dropped = self.rank, self.rows, 0
        for pivot, (less, up_to) in zip(pivots, counts, strict=True):
            if less < rank <= up_to:
                self.found = pivot
                return
            if up_to < rank:
                self.above, dropped = pivot, up_to
            else:
                self.below, rows = pivot, less
                break
        if rows - dropped >= self.rows:
            raise RuntimeError(f"{self.rows} rows between {self.above} and {self.below} were not divided by {pivots}")
        self.rank, self.rows = rank - dropped, rows - dropped


def _around(position: float) -> list[float]:
    step = 2 / ACCURACY
    return [max(position - step, 0.0), position, min(position + step, 1.0)]


def _offset(v: Column, dtype: DataType, base: Any) -> Column:
    """How far a value is from the lower end of its interval: quantiles are computed in doubles, which hold the
    distances of neighbouring long numbers, but not always the numbers."""
    if isinstance(dtype, (FloatType, DoubleType)):
        return v
    if not isinstance(dtype, DecimalType):
        v, base = v.cast("decimal(20, 0)"), decimal.Decimal(base)
    return (v - F.lit(base)).cast("double")


def _pivot(quantile: float, dtype: DataType, base: Any) -> Any:
    """The value at that distance, or one next to it."""
    if isinstance(dtype, (FloatType, DoubleType)):
        return quantile
    if isinstance(dtype, DecimalType):
        with decimal.localcontext(prec=60):
            return (base + decimal.Decimal(quantile)).quantize(decimal.Decimal(1).scaleb(-dtype.scale))
    return base + round(quantile)


def exact_medians(df: DataFrame, names: Sequence[str]) -> dict[str, Any]:
    """The lower median (``percentile_disc(0.5)``) of each numeric column, None where all is null.

    Approximate quantiles close in on the median: the values next to them are looked up, counts say how many lie
    on either side, and only when at most ``FEW`` are left are they sorted. Each round is three scans of the
    named columns for all of them together, with partial aggregation and one row back to the driver; memory per
    task does not grow with the table. A value held by many rows is met as a pivot. Every round leaves fewer
    rows, or the job fails.

    The named columns are first written to the scratch folder, and removed at the end: whatever made the table,
    a shuffle perhaps, then runs once, and all passes see the same rows.
    """
    spark, schema = df.sparkSession, df.schema
    place = scratch_path(spark, "median")
    df.select(*[without_nan(n, schema[n].dataType).alias(f"v{i}") for i, n in enumerate(names)]).write.parquet(place)
    try:
        return _narrowed(spark.read.parquet(place), names, {n: schema[n].dataType for n in names})
    finally:
        remove(spark, place)


def _narrowed(df: DataFrame, names: Sequence[str], types: Mapping[str, DataType]) -> dict[str, Any]:
    at = {n: column(f"v{i}") for i, n in enumerate(names)}
    brackets = {n: _Bracket() for n in names}

    def one(columns: Mapping[Any, Column]) -> dict[Any, Any]:
        """Aggregates by name, from one scan."""
        row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(columns.values())]).first()
        return dict(zip(columns, row, strict=True))

    first = one({(n, k): f(at[n]) for n in names for k, f in (("rows", F.count), ("least", F.min))})
    for n, b in brackets.items():
        b.rows = first[n, "rows"]
        b.rank = (b.rows + 1) // 2

    while wide := [n for n, b in brackets.items() if b.found is None and b.rows > FEW]:
        inside = {n: brackets[n].values(at[n]) for n in wide}
        base = {n: first[n, "least"] if brackets[n].above is None else brackets[n].above for n in wide}
        position = {n: _around((brackets[n].rank - 0.5) / brackets[n].rows) for n in wide}
        quantiles = one(
            {n: F.percentile_approx(_offset(inside[n], types[n], base[n]), position[n], ACCURACY) for n in wide}
        )
        near = {(n, i): _pivot(q, types[n], base[n]) for n in wide for i, q in enumerate(quantiles[n])}
        beside = one(
            {
                (key, side): take(F.when(test(inside[key[0]], F.lit(p).cast(types[key[0]])), inside[key[0]]))
                for key, p in near.items()
                for side, take, test in (("up", F.min, operator.ge), ("down", F.max, operator.le))
            }
        )
        held = {k: beside[k, "down"] if beside[k, "up"] is None else beside[k, "up"] for k in near}
        pivots = {n: sorted({held[k] for k in near if k[0] == n}) for n in wide}
        counts = one(
            {
                (n, p, k): F.count_if(test(inside[n], F.lit(p)))
                for n in wide
                for p in pivots[n]
                for k, test in enumerate((operator.lt, operator.le))
            }
        )
        for n in wide:
            brackets[n].narrow(pivots[n], [(counts[n, p, 0], counts[n, p, 1]) for p in pivots[n]])

    if few := [n for n, b in brackets.items() if b.found is None and b.rows]:
        left = {n: F.sort_array(F.collect_list(brackets[n].values(at[n]))) for n in few}
        for n, median in one({n: F.get(left[n], F.lit(brackets[n].rank - 1)) for n in few}).items():
            brackets[n].found = median
    return {n: b.found for n, b in brackets.items()}
