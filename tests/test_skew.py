"""A third of all rows on one key, or a third of them copies of one row: what gets shuffled stays small."""

import pytest
from pyspark.sql import functions as F

from terrace import clean
from terrace.operators.features import build_features, entity_aggregates

ROWS, TASKS = 60_000, 8


def shuffled(df):
    """Rows written by each shuffle of a plan that has run."""

    def visit(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return visit(node.executedPlan())
        found = [node.metrics().apply("shuffleRecordsWritten").value()] if name == "Exchange" else []
        inner = [node.plan()] if "QueryStage" in name else []
        children = node.children()
        for child in inner + [children.apply(i) for i in range(children.size())]:
            found += visit(child)
        return found

    df.collect()
    return visit(df._jdf.queryExecution().executedPlan())


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows on key 0, of which 10,000 are the same row; the rest on 1,000 keys."""
    return spark.range(0, ROWS, 1, TASKS).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 0 ELSE 1 + id % 1000 END").alias("k"),
        F.expr("CASE WHEN id % 6 = 0 THEN 'same' ELSE concat('v', id) END").alias("v"),
        F.expr("CASE WHEN id % 6 = 0 THEN 0 ELSE id % 7 END").alias("n"),
    )


def test_copies_are_dropped_where_they_are_read(skewed):
    once = clean(skewed, ["remove_duplicates"], {})
    assert once.count() == 50_001
    assert shuffled(once) == [50_000 + TASKS]


@pytest.mark.parametrize("order", [None, ["n desc", "v"]])
def test_each_task_sends_one_row_of_a_key(skewed, order):
    rules = {"remove_duplicates": {"subset_cols": ["k"], "order_by": order}}
    keys = skewed.select("k").distinct().count()
    once = clean(skewed, ["remove_duplicates"], rules)
    assert once.count() == keys
    (sent,) = shuffled(once)
    assert sent <= keys * TASKS
    if order:
        hot = [(-(i % 7), f"v{i}") for i in range(0, ROWS, 3) if i % 6] + [(0, "same")]
        n, v = min(hot)
        assert once.where("k = 0").select("n", "v").first() == (-n, v)


def test_each_task_sends_one_row_of_an_entity(skewed):
    features = build_features(skewed, ["k"], [entity_aggregates({"n": ["sum", "max"]})])
    (sent,) = shuffled(features)
    assert sent <= 1_001 * TASKS


def test_distinct_counts_send_each_value_once_per_task(skewed):
    features = build_features(skewed, ["k"], [entity_aggregates({"n": ["count_distinct"]})])
    assert features.where("k = 0").select("n_count_distinct").first() == (7,)
    assert all(sent <= 1_001 * 7 * TASKS for sent in shuffled(features))


def test_statistics_send_one_row_per_task(skewed):
    filled = clean(skewed, ["null_handling"], {"null_handling": {"n": "median", "k": "mean"}})
    learnt = filled.select("n").agg(F.count("n"))
    assert max(shuffled(learnt)) <= TASKS


def test_sketches_of_a_median_meet_in_two_levels(spark, monkeypatch):
    import terrace.operators.nulls as nulls

    monkeypatch.setattr(nulls, "MERGED", 2)
    row = nulls._learned(spark.range(0, ROWS, 1, TASKS), {"id": "median"}, 250)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        merged, sketched = sorted(shuffled(row))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert 1 < merged <= TASKS // 2 and sketched == TASKS
    assert abs(row.first()["s0"] - ROWS / 2) < 0.01 * ROWS


@pytest.mark.parametrize("bytes_", [None, 0], ids=["broadcast", "merged"])
def test_only_known_words_are_brought_together_again(spark, bytes_):
    from terrace.operators.lemmas import lemmatize

    texts = spark.range(0, 300, 1, TASKS).selectExpr("id AS k", "concat(repeat('a b  ', 100), 'known ', repeat('c ', 9), 'known') AS t")
    words = spark.createDataFrame([("known", "k")], "token string, lemma string")
    done = lemmatize(texts, "k", "t", words, broadcast_bytes=bytes_)
    assert {r["t"] for r in done.collect()} == {"a b  " * 100 + "k " + "c " * 9 + "k"}

    def below(node):
        name, children = node.nodeName(), node.children()
        if name.startswith("AdaptiveSparkPlan"):
            return [node.executedPlan()]
        return [node.plan()] if "QueryStage" in name else [children.apply(i) for i in range(children.size())]

    def nodes(node):
        return [node] + [n for c in below(node) for n in nodes(c)]

    plan = nodes(done._jdf.queryExecution().executedPlan())
    kept = [n for n in plan if n.nodeName() == "Filter" and any(m.nodeName() == "Generate" for m in nodes(n))]
    assert kept and kept[0].metrics().apply("numOutputRows").value() == 300 * 3


def test_a_hot_word_meets_a_large_dictionary_in_many_tasks(spark):
    from terrace.operators.lemmas import lemmatize

    texts = spark.range(0, 3000, 1, TASKS).selectExpr("id AS k", "concat('hot w', id, ' hot v', id % 100) AS t")
    words = spark.range(2000).selectExpr("concat('w', id) AS token", "'w' AS lemma").union(
        spark.createDataFrame([("hot", "cold")], "token string, lemma string")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = lemmatize(texts, "k", "t", words, broadcast_bytes=0)
        plan = done._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        got = {r["k"]: r["t"] for r in done.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {i: f"cold {'w' if i < 2000 else f'w{i}'} cold v{i % 100}" for i in range(3000)}
