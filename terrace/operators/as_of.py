"""Features as they were at an instant of each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from terrace.functions import column
from terrace.operators.base import require_columns


def _slice(at: Column, zoned: bool, hours: int) -> Column:
    """The number of a stretch of so many hours, counted from 1970."""
    if zoned:
        return F.floor(F.unix_seconds(at) / F.lit(3600 * hours))
    whole = F.datediff(at.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour(at)
    return F.floor(whole / F.lit(hours))


def join_as_of(
    rows: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    time: str,
    history_time: str,
    values: Sequence[str],
    *,
    ties: Sequence[str] = (),
    within_days: int | None = None,
    slice_hours: int = 24,
) -> DataFrame:
    """Each row of ``rows`` as it is, with ``values`` of the last row of ``history`` for its keys at or before its time.

    The values are null where there is none, where it is older than ``within_days``, and where a time is null. Of rows
    of history with equal times the one with the largest ``ties`` counts, then with the largest ``values``. Null keys
    are equal. ``keys`` have the same names in both tables; a value named like a column of ``rows`` is an error.
    Repeated rows stay repeated.

    Nothing is joined: rows and history are put into one order of time, in which the last history is carried on. An
    entity's time is cut into slices of ``slice_hours``, each a group by itself, so that an entity with a third of all
    rows is many; what a slice begins with is carried over from a table of one row per entity and slice.
    """
    require_columns(rows, [*keys, time])
    require_columns(history, [*keys, history_time, *ties, *values])
    if twice := [v for v in values if v in rows.columns]:
        raise ValueError("columns of that name are there already: " + ", ".join(twice))
    if not keys or not values:
        raise ValueError("name at least one key and one value")
    kinds = [rows.schema[time].dataType, history.schema[history_time].dataType]
    zoned = all(isinstance(k, TimestampType) for k in kinds)
    instant = (lambda n: column(n)) if zoned else (lambda n: column(n).cast("timestamp_ntz"))
    names = [f"k{i}" for i in range(len(keys))]

    def placed(df: DataFrame, at: str, *more: Column) -> DataFrame:
        chosen = df.select(*[column(k).alias(n) for k, n in zip(keys, names)], instant(at).alias("at"), *more)
        return chosen.withColumn("slice", _slice(F.col("at"), zoned, slice_hours))

    told = F.struct(
        instant(history_time).alias("at"), F.struct(*[column(c) for c in (*ties, *values)]).alias("order"),
        F.struct(*[column(v) for v in values]).alias("values"),
    )
    known = placed(history, history_time, told.alias("found")).where("at IS NOT NULL")
    asked = placed(rows, time, F.struct(*[column(c) for c in rows.columns]).alias("row"))

    within = Window.partitionBy(*names).orderBy("slice")
    latest = known.groupBy(*names, "slice").agg(F.max("found").alias("found"), F.lit(False).alias("asked"))
    wanted = asked.where("at IS NOT NULL").groupBy(*names, "slice").agg(F.lit(True).alias("asked"))
    each = latest.unionByName(wanted, allowMissingColumns=True).groupBy(*names, "slice")
    each = each.agg(F.max("found").alias("found"), F.max("asked").alias("asked"))
    before = F.last("found", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, -1))
    carried = each.withColumn("before", before).where("asked AND before IS NOT NULL")
    carried = carried.select(*names, F.col("before.at").alias("at"), F.col("before").alias("found"), "slice")

    line = known.unionByName(carried).unionByName(asked, allowMissingColumns=True)
    # A row without a time has no slice; each gets one of its own, so that they do not meet in one task.
    apart = F.when(F.col("at").isNull(), F.monotonically_increasing_id())
    order = Window.partitionBy(*names, "slice", "apart").orderBy("at", F.col("row").isNotNull(), F.col("found"))
    last = F.last("found", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = line.withColumn("apart", apart).withColumn("last", last).where("row IS NOT NULL")
    good = F.col("last").isNotNull()
    if within_days is not None:
        good &= F.col("last.at") >= F.col("at") - F.make_dt_interval(F.lit(within_days))
    return met.select("row.*", *[F.when(good, F.col("last.values").getField(v)).alias(v) for v in values])
