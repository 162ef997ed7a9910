import datetime

import pytest
from pyspark.sql import functions as F

from terrace.operators import lemmas
from terrace.operators.features import (
    STRATEGIES,
    build_features,
    category_counts,
    entity_aggregates,
    join_features,
    register_strategy,
    strategy,
    time_window_aggregates,
)
from terrace.operators.lemmas import lemmatize


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def sales(spark):
    day = datetime.datetime(2024, 1, 31)
    ago = lambda n: day - datetime.timedelta(days=n)
    data = [
        ("a", 1, ago(0), "x"),
        ("a", 2, ago(1), "y"),
        ("a", 2, ago(7), "x"),
        ("b", None, ago(40), "z"),
        (None, 5, ago(-1), "x"),
    ]
    return spark.createDataFrame(data, "who string, v int, at timestamp_ntz, kind string")


def test_entity_aggregates(sales):
    every = entity_aggregates({"v": ["count", "sum", "avg", "min", "max", "count_distinct"]})
    got = build_features(sales, ["who"], [every])
    assert got.columns == ["who", "rows", "v_count", "v_sum", "v_avg", "v_min", "v_max", "v_count_distinct"]
    assert rows(got) == [
        ("a", 3, 3, 5, 5 / 3, 1, 2, 2),
        ("b", 1, 0, None, None, None, None, 0),
        (None, 1, 1, 5, 5.0, 5, 5, 1),
    ]


def test_windows_end_at_the_instant_and_leave_out_their_start(sales):
    windows = time_window_aggregates("at", "2024-01-31 00:00:00", [1, 7, 60], {"v": ["sum"]})
    got = build_features(sales, ["who"], [windows])
    assert rows(got) == [("a", 1, 1, 2, 3, 3, 5), ("b", 0, None, 0, None, 1, None), (None, 0, None, 0, None, 0, None)]


def test_categories(sales):
    got = build_features(sales, ["who"], [category_counts("kind", ["x", "y"])])
    assert rows(got) == [("a", 2, 1), ("b", 0, 0), (None, 1, 0)]


def test_joined_features_keep_every_entity_and_null_is_one(spark, sales):
    other = spark.createDataFrame([("b", 1), ("c", 2), (None, 3)], "who string, w int")
    joined = join_features(
        [
            build_features(sales, ["who"], [entity_aggregates({}, rows="sales")]),
            build_features(other, ["who"], [entity_aggregates({"w": ["max"]}, rows=None)]),
        ],
        ["who"],
    )
    assert rows(joined) == [("a", 3, None), ("b", 1, 1), ("c", None, 2), (None, 1, 3)]
    with pytest.raises(ValueError, match="w_max"):
        part = build_features(other, ["who"], [entity_aggregates({"w": ["max"]})])
        join_features([part, part], ["who"])


def test_strategies_by_name(sales):
    register_strategy("spread", lambda c: [(F.max(c) - F.min(c)).alias(f"{c}_spread")])
    try:
        assert rows(build_features(sales, ["who"], [strategy({"strategy": "spread", "c": "v"})]))[0] == ("a", 1)
    finally:
        del STRATEGIES["spread"]
    with pytest.raises(ValueError, match="unknown strategy 'spread'"):
        strategy({"strategy": "spread"})
    with pytest.raises(ValueError, match="unknown aggregate 'mode'"):
        entity_aggregates({"v": ["mode"]})
    with pytest.raises(ValueError, match="twice: rows"):
        build_features(sales, ["who"], [entity_aggregates({}), entity_aggregates({})])
    with pytest.raises(ValueError, match="nope"):
        build_features(sales, ["nope"], [entity_aggregates({})])


@pytest.mark.parametrize("limit", [lemmas.BROADCAST_BYTES, -1], ids=["broadcast", "salted"])
def test_lemmas(spark, monkeypatch, limit):
    monkeypatch.setattr(lemmas, "BROADCAST_BYTES", limit)
    texts = [(1, "running dogs  run", "x"), (2, "", "y"), (3, None, "z"), (4, "dogs " * 500, None), (5, " dogs", "v")]
    df = spark.createDataFrame(texts, "position int, text string, token string")
    words = [("running", "run"), ("dogs", "dog"), ("dogs", "doggy"), ("x", None), (None, "y")]
    got = lemmatize(df, "position", "text", spark.createDataFrame(words, "token string, lemma string"))
    assert got.columns == df.columns
    assert rows(got) == [
        (1, "run dog  run", "x"),
        (2, "", "y"),
        (3, None, "z"),
        (4, "dog " * 500, None),
        (5, " dog", "v"),
    ]


def test_lemmas_need_a_key_that_identifies(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "c")], "k int, t string")
    with pytest.raises(Exception, match="not unique"):
        lemmatize(df, "k", "t", spark.createDataFrame([("a", "b")], "token string, lemma string")).collect()


def test_a_large_dictionary_is_not_broadcast(spark, sf):
    entries = spark.range(1_000_000).selectExpr("concat('token', id) AS token", "concat('lemma', id) AS lemma")
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    plan = lemmatize(documents, "doc_id", "text", entries)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan


def test_recent_windows_read_what_is_in_them(spark, sales, sf):
    spec = {"v": ["sum"], "kind": ["count_distinct"]}
    recent = time_window_aggregates("at", "2024-01-31 00:00:00", [1, 7], spec, recent_only=True)
    every = time_window_aggregates("at", "2024-01-31 00:00:00", [1, 7], spec)
    assert [r for r in rows(build_features(sales, ["who"], [every])) if r[1] or r[3]] == rows(build_features(sales, ["who"], [recent]))
    both = build_features(sales, ["who"], [entity_aggregates({}), recent])
    assert [tuple(r)[:2] for r in both.orderBy("who").collect()] == [(None, 1), ("a", 3), ("b", 1)]
    events = spark.read.parquet(f"{sf}/events.parquet")
    windows = time_window_aggregates("ts", "2024-01-30", [1, 7], {"event_type": ["count_distinct"], "value": ["sum"]}, recent_only=True)
    plan = build_features(events, ["user_id"], [windows])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "PushedFilters: [IsNotNull(ts), GreaterThan(ts" in plan


def test_null_values_are_not_distinct_ones(spark):
    at = datetime.datetime(2024, 1, 31)
    df = spark.createDataFrame([("a", None, at), ("a", "x", at), ("a", "x", at), ("b", None, at)], "who string, v string, at timestamp_ntz")
    windows = time_window_aggregates("at", "2024-01-31 00:00:00", [1], {"v": ["count_distinct"]})
    assert rows(build_features(df, ["who"], [windows])) == [("a", 3, 1), ("b", 1, 0)]
