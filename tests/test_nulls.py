import decimal

import pytest

import terrace.operators.median as median_module
from terrace import clean
from terrace.operators import HandleNulls
from terrace.operators.median import exact_medians

NAN = float("nan")


@pytest.fixture(scope="module")
def df(spark):
    data = [(1, 1.0, "1", 10), (2, NAN, None, None), (4, 4.0, "x", 30), (None, None, "2", 20), (None, 4.0, "NaN", None)]
    return spark.createDataFrame(data, "i int, d double, s string, g long")


def both(df, rules, **options):
    """The lazily filled table and the model's, which must agree."""
    lazy = clean(df, ["null_handling"], {"null_handling": rules}, {"null_handling": options}).collect()
    assert repr(lazy) == repr(HandleNulls({"null_handling": rules}, **options).fit(df).transform(df).collect())
    return lazy


def test_means_are_cast_to_the_column(df):
    got = both(df, {"i": "mean", "d": "mean"})
    assert [r["i"] for r in got] == [1, 2, 4, 2, 2]
    assert [r["d"] for r in got] == [1.0, 3.0, 4.0, 3.0, 4.0]


def test_the_mean_of_text_reads_its_numbers(df):
    assert [r["s"] for r in both(df, {"s": "mean"})] == ["1", "1.5", "x", "2", "NaN"]


def test_medians(df):
    for options in ({}, {"exact_median": True}, {"accuracy": 50}):
        got = both(df, {"g": "median", "d": "median"}, **options)
        assert [r["g"] for r in got] == [10, 20, 30, 20, 20]
        assert [r["d"] for r in got] == [1.0, 4.0, 4.0, 4.0, 4.0]


def test_decimals(spark):
    values = [decimal.Decimal("1.00"), decimal.Decimal("2.01"), None]
    df = spark.createDataFrame([(v, v) for v in values], "a decimal(10,2), b decimal(10,2)")
    got = both(df, {"a": "mean", "b": "median"})
    assert got[2] == (decimal.Decimal("1.51"), decimal.Decimal("1.00"))
    assert both(df, {"b": "median"}, exact_median=True)[2]["b"] == decimal.Decimal("1.00")


def test_constants_take_the_type_of_the_column(df):
    got = both(df, {"i": "7", "d": 2, "s": 0, "g": 2.9})
    assert got[3][:2] == (7, 2.0)
    assert got[1]["d"] == 2.0 and got[1]["s"] == "0" and got[1]["g"] == 2


def test_the_words_mean_and_median_as_constants(df):
    assert both(df, {"s": {"value": "mean"}})[1]["s"] == "mean"


def test_constants_that_do_not_fit_are_refused_before_any_row_is_read(df):
    with pytest.raises(ValueError, match="'abc' cannot fill column 'i' of type int"):
        clean(df, ["null_handling"], {"null_handling": {"i": "abc"}})
    with pytest.raises(ValueError, match="not a way to fill"):
        clean(df, ["null_handling"], {"null_handling": {"i": [1]}})


def test_statistics_need_numbers(df):
    with pytest.raises(ValueError, match="convert it"):
        clean(df, ["null_handling"], {"null_handling": {"s": "median"}})


def test_columns_of_nothing_but_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, None)], "a double, b int")
    rules = {"null_handling": {"a": "mean", "b": "median"}}
    for exact in (False, True):
        with pytest.raises(ValueError, match="a mean or median of in: a"):
            HandleNulls({"null_handling": {"a": "median", "b": "mean"}}, exact_median=exact).fit(df)
    with pytest.raises(Exception, match="a mean or median of in: a"):  # as Spark wraps it
        clean(df, ["null_handling"], rules).collect()
    kept = both(df, rules["null_handling"], on_empty="keep")
    assert [tuple(r) for r in kept] == [(None, 1), (None, 1)]
    with pytest.raises(ValueError, match="on_empty"):
        HandleNulls({}, on_empty="guess")


def test_streams_take_models_and_constants_only(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="not a stream"):
        clean(stream, ["null_handling"], {"null_handling": {"value": "mean"}})
    assert clean(stream, ["null_handling"], {"null_handling": {"value": 0}}).isStreaming


@pytest.mark.parametrize("few", [1, 3, 10_000])
def test_exact_medians_narrow_down_to_the_same_value(spark, monkeypatch, few):
    monkeypatch.setattr(median_module, "FEW", few)
    monkeypatch.setattr(median_module, "ACCURACY", 20)
    df = spark.range(20_000).selectExpr(
        "CASE WHEN id % 7 <> 0 THEN pmod(xxhash64(id), 100000) END AS spread",
        "CASE WHEN id % 3 = 0 THEN 5.5D ELSE CAST(pmod(xxhash64(id, 1), 1000) AS DOUBLE) END AS hot",
        "CASE WHEN id % 2 = 0 THEN 1 ELSE 2 END AS halves",
        "CAST(pmod(xxhash64(id, 2), 9999) AS DECIMAL(10, 1)) / 7 AS d",
        "CAST(pmod(xxhash64(id, 3), 9999) / 7 AS FLOAT) AS f",
        "CASE WHEN id % 2 = 0 THEN double('NaN') ELSE double(id) END AS n",
        "CAST(NULL AS INT) AS empty",
    )
    got = exact_medians(df, df.columns)
    for name in df.columns:
        values = sorted(r[0] for r in df.select(name).collect() if r[0] is not None and r[0] == r[0])
        assert got[name] == (values[(len(values) - 1) // 2] if values else None), name


def test_exact_medians_of_numbers_that_doubles_do_not_hold(spark, monkeypatch):
    monkeypatch.setattr(median_module, "FEW", 100)
    df = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 < 2 THEN 1700000000000000000 + id ELSE 1700000000000000777 END AS close",
        "CASE WHEN id < 20001 THEN 1700000000000000001 ELSE 1700000000000000000 + id * 1000 END AS hot",
        "CASE WHEN id < 17001 THEN CAST('12345678901234567890.123456789012345678' AS DECIMAL(38, 18))"
        " ELSE CAST(id AS DECIMAL(38, 18)) / 7 END AS d",
        "CASE id % 2 WHEN 0 THEN -9223372036854775807 + id ELSE 9223372036854775807 - id END AS ends",
    )
    got = exact_medians(df, df.columns)
    for name in df.columns:
        values = sorted(r[0] for r in df.select(name).collect())
        assert got[name] == values[(len(values) - 1) // 2], name


def test_a_pass_that_leaves_all_rows_fails():
    bracket = median_module._Bracket(above=1, below=9, rank=5, rows=10)
    with pytest.raises(RuntimeError, match="not divided"):
        bracket.narrow([1], [(0, 0)])


def test_the_written_copy_is_removed(spark, tmp_path):
    import os

    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = {x for x in os.listdir(base)} if os.path.isdir(base) else set()
    exact_medians(spark.range(10).toDF("i"), ["i"])
    assert {x for x in os.listdir(base) if x.startswith("median")} <= before
