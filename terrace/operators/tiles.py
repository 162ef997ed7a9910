"""Features over ranges of time from aggregates per entity and day.

A tile holds what the rows of an entity on one day come to. Features as of any instant merge the tiles of whole days,
and take from the rows themselves only the days that a range begins and ends in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.functions import column
from terrace.operators.base import require_columns
from terrace.sources.tables import read_table, register

DAY = "tile_day"
ROWS = "tile_rows"
#: What a feature is made of, and how two tiles' parts become one.
PARTS: dict[str, tuple[str, ...]] = {"count": ("count",), "sum": ("sum",), "avg": ("sum", "count"), "min": ("min",), "max": ("max",)}
_MERGED = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _parts(columns: Mapping[str, Sequence[str]]) -> list[tuple[str, str]]:
    """The parts that the features need, each once: column and kind."""
    unknown = sorted({a for names in columns.values() for a in names if a not in PARTS})
    if unknown:
        raise ValueError(f"no merging of days gives {', '.join(unknown)}: use some of {', '.join(PARTS)}")
    return list(dict.fromkeys((c, p) for c, names in columns.items() for a in names for p in PARTS[a]))


def _part(c: str, kind: str) -> str:
    return f"{c}_{kind}"


def _time(name: str) -> Column:
    return column(name).cast("timestamp_ntz")


def build_tiles(df: DataFrame, keys: Sequence[str], time: str, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """A row per entity and day with rows: ``tile_day``, ``tile_rows`` and the parts that ``columns`` need.

    ``columns`` names the aggregates of each column, ``count``, ``sum``, ``avg``, ``min`` or ``max``. Null keys are an
    entity; rows without a time are in no tile.
    """
    require_columns(df, [*keys, time, *columns])
    made = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    aggregates = [made[kind](column(c)).alias(_part(c, kind)) for c, kind in _parts(columns)]
    dated = df.where(column(time).isNotNull()).withColumn(DAY, _time(time).cast("date"))
    return dated.groupBy(*[column(k) for k in keys], DAY).agg(F.count(F.lit(1)).alias(ROWS), *aggregates)


def write_tiles(
    df: DataFrame, table: str, location: str, keys: Sequence[str], time: str, columns: Mapping[str, Sequence[str]]
) -> str:
    """Put the tiles of the days that ``df`` has rows of in the place of what the table has for these days.

    ``df`` must hold all rows of these days: late rows are added by giving their whole days again, and a run can be
    repeated. Other days stay as they are. The table is partitioned by day.
    """
    spark = df.sparkSession
    tiles = build_tiles(df, keys, time, columns).hint("rebalance", DAY)
    writer = tiles.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY).parquet(location)
    schema = StructType([f for f in tiles.schema if f.name != DAY] + [tiles.schema[DAY]])
    return register(spark, table, location, schema=schema, partitions=[DAY])


def read_tiles(spark: SparkSession, table: str) -> DataFrame:
    return read_table(spark, table)


def _instant(as_of: datetime | str) -> datetime:
    at = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
    if at.tzinfo:
        raise ValueError("give the instant without a zone, as the tiles' days have none")
    return at


def features_from_tiles(
    tiles: DataFrame,
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    as_of: datetime | str,
    days: Sequence[int],
    columns: Mapping[str, Sequence[str]],
    rows: str = "rows",
) -> DataFrame:
    """What ``time_window_aggregates`` gives over the last so many days up to and including ``as_of``, for the entities
    with rows in the longest range: ``rows_7d``, ``column_sum_7d`` ..

    Whole days come from ``tiles`` (``build_tiles`` with at least these columns), of which only the days in the longest
    range are read; the days that a range begins and ends in come from ``df``, of which no others are read.
    """
    if not days or min(days) < 1:
        raise ValueError("a range is at least a day")
    end, parts = _instant(as_of), _parts(columns)
    require_columns(tiles, [*keys, DAY, ROWS, *[_part(c, kind) for c, kind in parts]])
    starts = {n: end - timedelta(days=n) for n in days}
    first = min(s.date() for s in starts.values())
    names = [_part(c, kind) for c, kind in parts]

    def day(d: date) -> Column:
        return F.lit(d.isoformat()).cast("date")

    def moment(t: datetime) -> Column:
        return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")

    whole = tiles.where((F.col(DAY) > day(first)) & (F.col(DAY) < day(end.date())))
    whole = whole.select(*[column(k) for k in keys], DAY, F.lit(None).cast("timestamp_ntz").alias("tile_time"), ROWS, *[column(n) for n in names])

    midnight = lambda d: datetime(d.year, d.month, d.day)
    edges = sorted({s.date() for s in starts.values()} | {end.date()})
    on_edge = [(_time(time) >= moment(midnight(d))) & (_time(time) < moment(midnight(d) + timedelta(days=1))) for d in edges]
    inside = (_time(time) > moment(min(starts.values()))) & (_time(time) <= moment(end))
    cut = df.where(inside & reduce(or_, on_edge))
    single = {"count": lambda c: column(c).isNotNull().cast("long"), "sum": column, "min": column, "max": column}
    types = {n: tiles.schema[n].dataType for n in names}
    own = [single[kind](c).cast(types[_part(c, kind)]).alias(_part(c, kind)) for c, kind in parts]
    cut = cut.select(*[column(k) for k in keys], _time(time).cast("date").alias(DAY), _time(time).alias("tile_time"), F.lit(1).cast("long").alias(ROWS), *own)

    features = []
    for n, start in starts.items():
        as_tile = F.col("tile_time").isNull() & (F.col(DAY) > day(start.date()))
        as_row = F.col(DAY).isin(day(start.date()), day(end.date())) & (F.col("tile_time") > moment(start))
        counted = as_tile | as_row
        features.append(F.coalesce(F.sum(F.when(counted, F.col(ROWS))), F.lit(0)).alias(f"{rows}_{n}d"))
        merged = {(c, kind): _MERGED[kind](F.when(counted, column(_part(c, kind)))) for c, kind in parts}
        for c, wanted in columns.items():
            for a in wanted:
                if a == "avg":
                    found = F.try_divide(merged[c, "sum"], merged[c, "count"])
                else:
                    found = F.coalesce(merged[c, a], F.lit(0)) if a == "count" else merged[c, a]
                features.append(found.alias(f"{c}_{a}_{n}d"))
    return whole.unionByName(cut).groupBy(*[column(k) for k in keys]).agg(*features)
