"""Features at an instant of each row, and from tiles of days."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from terrace import read_table
from terrace.operators.as_of import join_as_of
from terrace.operators.features import build_features, time_window_aggregates
from terrace.operators.tiles import DAY, build_tiles, features_from_tiles, write_tiles

START = datetime(2024, 3, 30)


def brute(rows, history, within=None):
    out = []
    for key, at, n in rows:
        past = [(t, o, v) for k, t, o, v in history if k == key and t is not None and at is not None and t <= at]
        best = max(past, key=lambda p: (p[0], p[1], (p[2] is not None, p[2] or ""))) if past else None
        if best and within is not None and best[0] < at - timedelta(days=within):
            best = None
        out.append((key, at, n, best[2] if best else None))
    return sorted(out, key=repr)


def tables(spark, seed, kind="timestamp_ntz"):
    rng = random.Random(seed)
    at = lambda: rng.choice([None] + [START + timedelta(hours=rng.randint(0, 200))] * 9)
    keys = [None, "a", "b", "hot", "hot", "hot"]
    history = [(rng.choice(keys), at(), rng.randint(0, 2), rng.choice([None, "x", "y", "z"])) for _ in range(150)]
    rows = [(rng.choice([*keys, "new"]), at(), n) for n in range(120)]
    rows += rows[:5]
    left = spark.createDataFrame(rows, f"k string, at {kind}, n int")
    right = spark.createDataFrame(history, f"k string, since {kind}, turn int, `the value` string")
    return rows, history, left, right


@pytest.mark.parametrize("kind, hours", [("timestamp_ntz", 24), ("timestamp_ntz", 5), ("timestamp", 24), ("timestamp", 1000)])
def test_as_of_is_the_last_before(spark, kind, hours):
    rows, history, left, right = tables(spark, hours, kind)
    got = join_as_of(left.repartition(3), right, ["k"], "at", "since", ["the value"], ties=["turn"], slice_hours=hours)
    assert got.columns == ["k", "at", "n", "the value"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, history)


def test_values_grow_old(spark):
    rows, history, left, right = tables(spark, 9)
    got = join_as_of(left, right, ["k"], "at", "since", ["the value"], ties=["turn"], within_days=1)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, history, 1)


def test_as_of_odd_tables(spark):
    _, _, left, right = tables(spark, 1)
    assert join_as_of(left.limit(0), right, ["k"], "at", "since", ["turn"]).count() == 0
    alone = join_as_of(left, right.limit(0), ["k"], "at", "since", ["turn"])
    assert alone.count() == left.count() and alone.where("turn IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="already: n"):
        join_as_of(left, right.withColumn("n", F.lit(1)), ["k"], "at", "since", ["n"])
    with pytest.raises(ValueError, match="no such column"):
        join_as_of(left, right, ["k"], "when", "since", ["turn"])


def test_a_hot_entity_is_cut_by_time(spark):
    """What one window has to hold is a slice of the hot entity, not all of it."""
    history = spark.range(20_000).selectExpr("'hot' AS k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 60) AS since", "id AS v")
    rows = spark.range(5_000).selectExpr("'hot' AS k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id * 4, 1) AS at", "id")
    got = join_as_of(rows, history, ["k"], "at", "since", ["v"], slice_hours=6)
    assert got.where("v <> least(id * 4, 19999)").count() == 0 and got.count() == 5_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k0" in plan and "slice" in plan


def events(spark, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        at = START + timedelta(days=rng.randint(0, 9), seconds=rng.choice([0, 0, 1, 43200, rng.randrange(86400)]))
        rows.append((rng.choice([None, 1, 2, 3, 3, 3]), rng.choice([None] + [at] * 20), rng.choice([None, 1, 5, -2, i])))
    return spark.createDataFrame(rows, "user long, at timestamp_ntz, v long")


COLUMNS = {"v": ["count", "sum", "min", "max", "avg"]}


@pytest.mark.parametrize("as_of", ["2024-04-05 12:00:00", "2024-04-05 00:00:00", "2024-04-20 07:00:00", "2024-03-30 00:00:00"])
def test_tiles_give_what_the_rows_give(spark, as_of):
    df = events(spark)
    got = features_from_tiles(build_tiles(df, ["user"], "at", COLUMNS), df, ["user"], "at", as_of, [1, 3, 7], COLUMNS)
    want = build_features(df, ["user"], [time_window_aggregates("at", as_of, [1, 3, 7], COLUMNS, recent_only=True)])
    rows = lambda d: sorted((tuple(r) for r in d.select(*want.columns).collect()), key=repr)
    assert set(got.columns) == set(want.columns) and rows(got) == rows(want)


def test_days_given_again_replace_their_tiles(spark, tmp_path, database):
    df = events(spark)
    spark.sql(f"CREATE DATABASE {database}")
    name, place = f"{database}.tiles", str(tmp_path / "tiles")
    day = F.col("at").cast("date")
    late = df.where(day <= "2024-04-03").limit(50)  # some rows of the first days came early
    write_tiles(late, name, place, ["user"], "at", COLUMNS)
    write_tiles(df.where(day <= "2024-04-03"), name, place, ["user"], "at", COLUMNS)
    write_tiles(df.where(day > "2024-04-03"), name, place, ["user"], "at", COLUMNS)
    rows = lambda d: sorted((tuple(r) for r in d.select("user", DAY, "tile_rows", "v_sum", "v_min").collect()), key=repr)
    assert rows(read_table(spark, name)) == rows(build_tiles(df, ["user"], "at", COLUMNS))


def test_tiles_and_two_days_are_all_that_is_read(spark, tmp_path, database):
    spark.sql(f"CREATE DATABASE {database}")
    df = events(spark).withColumn("day", F.col("at").cast("date").cast("string"))
    df.write.partitionBy("day").parquet(str(tmp_path / "rows"))
    write_tiles(df, f"{database}.tiles", str(tmp_path / "tiles"), ["user"], "at", COLUMNS)
    stored = spark.read.schema(df.schema).parquet(str(tmp_path / "rows"))
    got = features_from_tiles(read_table(spark, f"{database}.tiles"), stored, ["user"], "at", "2024-04-06 12:00:00", [5], COLUMNS)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tile_day" in plan and "(tile_day#" in plan
    assert "LessThanOrEqual(at,2024-04-06T12:00), Or(And(Gr" in plan and "GreaterThan(at,2024-04-01T12:00)" in plan


def test_what_days_cannot_give(spark):
    df = events(spark)
    with pytest.raises(ValueError, match="count_distinct"):
        build_tiles(df, ["user"], "at", {"v": ["count_distinct"]})
    with pytest.raises(ValueError, match="a day"):
        features_from_tiles(build_tiles(df, ["user"], "at", COLUMNS), df, ["user"], "at", "2024-04-06", [], COLUMNS)
    assert features_from_tiles(build_tiles(df.limit(0), ["user"], "at", COLUMNS), df.limit(0), ["user"], "at", "2024-04-06", [2], COLUMNS).count() == 0
