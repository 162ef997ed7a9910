"""Values that make up a share of a table."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrace.operators import frequent
from terrace.operators.features import build_features, strategy
from terrace.operators.frequent import FrequentCategories, frequent_values


def wanted(values, share):
    met = Counter(v for v in values if v is not None)
    total = sum(met.values())
    return [v for v, n in sorted(met.items(), key=lambda e: (-e[1], e[0])) if n >= share * total]


@pytest.mark.parametrize("share", [0.001, 0.02, 0.3, 1])
@pytest.mark.parametrize("kind", ["string", "bigint", "date"])
def test_frequent_values_are_those_of_a_full_count(spark, monkeypatch, share, kind):
    monkeypatch.setattr(frequent, "MERGED", 2)
    rng = random.Random(7)
    numbers = [min(int(rng.paretovariate(0.7)), 500) for _ in range(6000)] + [None] * 900
    df = spark.createDataFrame([(v,) for v in numbers], "`the value` bigint").repartition(9)
    cast = {"string": "CAST(`the value` AS STRING)", "bigint": "`the value`", "date": "date_add(date'2024-01-01', CAST(`the value` AS INT))"}
    df = df.select(F.expr(cast[kind]).alias("the value"))
    assert frequent_values(df, "the value", share) == wanted([r[0] for r in df.collect()], share)


def test_no_task_sees_all_values(spark):
    """A third of the rows have one value and each other row has its own: what is counted is candidates only."""
    df = spark.range(0, 60_000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('v', id) END AS c")
    assert frequent_values(df, "c", 0.1) == ["hot"]
    candidates = frequent._candidates(df, "c", 0.1)
    assert "hot" in candidates and len(candidates) <= frequent.PLACES / 0.1


def test_features(spark):
    rows = [("a", "x")] * 5 + [("a", "y")] * 2 + [("b", "y")] * 4 + [("b", "rare"), ("b", None), (None, "x")]
    df = spark.createDataFrame(rows, "user string, kind string")
    spec = strategy({"strategy": "frequent_categories", "category": "kind", "share": 0.2})
    got = {r.user: tuple(r)[1:] for r in build_features(df, ["user"], [spec]).select("user", "kind_x", "kind_y", "kind_other").collect()}
    assert got == {"a": (5, 2, 0), "b": (0, 4, 1), None: (1, 0, 0)}
    alone = build_features(df, ["user"], [FrequentCategories("kind", 0.2, rest=None)])
    assert alone.columns == ["user", "kind_x", "kind_y"]


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, "a")] * 3, "kind string, user string")
    assert frequent_values(df, "kind", 0.5) == [] and frequent_values(df.limit(0), "kind", 0.5) == []
    assert build_features(df, ["user"], [FrequentCategories("kind", 0.5)]).collect()[0].kind_other == 0
    for share in (0, 1.1):
        with pytest.raises(ValueError, match="share"):
            frequent_values(df, "kind", share)
    with pytest.raises(ValueError, match="no such column"):
        frequent_values(df, "sort", 0.5)
    other = spark.createDataFrame([("a", "other")], "user string, kind string")
    with pytest.raises(ValueError, match="twice"):
        build_features(other, ["user"], [FrequentCategories("kind", 0.5)])
