import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Observation
from pyspark.sql import functions as F

from terrace import build_pipeline, clean, register_step
from terrace.operators import ConvertTypes, HandleNulls, NormalizeTimestamp, RemoveDuplicates, RemoveNulls, Step
from terrace.plans.cleaning import STEPS
from terrace.scratch import scratch_path

NAN = float("nan")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def dups(spark):
    twice = [(1, "a", 1.0), (None, None, NAN)]
    data = [*twice, *twice, (2, "b", 0.0), (2, "b", -0.0), (1, "z", 1.0)]
    return spark.createDataFrame(data, "k int, v string, d double")


@pytest.mark.parametrize("section", [None, {}, {"subset_cols": None}, {"subset_cols": []}])
def test_duplicates_of_whole_rows(dups, section):
    got = clean(dups, ["remove_duplicates"], {"remove_duplicates": section})
    assert got.count() == 4


def test_duplicates_by_key(dups):
    assert rows(clean(dups, ["remove_duplicates"], {"remove_duplicates": {"subset_cols": "k"}}).select("k")) == [
        (1,),
        (2,),
        (None,),
    ]


def test_duplicates_by_key_with_a_chosen_winner(dups):
    rules = {"remove_duplicates": {"subset_cols": ["k"], "order_by": ["v desc"]}}
    assert rows(clean(dups, ["remove_duplicates"], rules).where("k = 1").select("v")) == [("z",)]


def test_column_names_with_dots_and_spaces(spark):
    data = [(" A ", None, "1"), (" A ", None, "1"), ("b", 2.0, "x")]
    df = spark.createDataFrame(data, "`a.b` string, `c d` double, `e``f` string")
    contract = {
        "remove_duplicates": {"subset_cols": ["a.b"], "order_by": ["e`f"]},
        "normalize_text": ["a.b"],
        "convert_types": {"e`f": "int"},
        "null_handling": {"c d": "mean"},
        "remove_nulls": {"subset_cols": ["e`f"]},
    }
    assert rows(clean(df, list(contract), contract)) == [("a", 2.0, 1)]


@pytest.fixture
def nulls(spark):
    data = [(1, 1.0, "a"), (None, 2.0, "b"), (3, NAN, "c"), (None, None, None), (None, NAN, None), (5, 5.0, None)]
    return spark.createDataFrame(data, "i int, d double, x string")


@pytest.mark.parametrize(
    ("section", "left"),
    [
        (None, 1),
        ({"how": "any"}, 1),
        ({"how": "all"}, 4),
        ({"subset_cols": ["i"]}, 3),
        ({"subset_cols": "d", "how": "all"}, 3),
        ({"subset_cols": ["i", "x"], "how": "all"}, 4),
    ],
)
def test_removing_nulls_counts_nan_as_null(nulls, section, left):
    got = clean(nulls, ["remove_nulls"], {"remove_nulls": section})
    assert got.count() == left
    how, subset = (section or {}).get("how", "any"), (section or {}).get("subset_cols")
    assert got.count() == nulls.dropna(how, subset=subset).count()


def test_unknown_how(nulls):
    with pytest.raises(ValueError, match="any or all"):
        RemoveNulls({"remove_nulls": {"how": "some"}}).transform(nulls)


@pytest.fixture
def casts(spark):
    data = ["7", " 7 ", "2.5", "1e3", "", "abc", "99999999999", "true", None]
    return spark.createDataFrame([(v,) for v in data], "s string").withColumn("kept", F.col("s"))


def test_values_that_do_not_cast_become_null(casts):
    got = clean(casts, ["convert_types"], {"convert_types": {"s": "int"}})
    assert {r["kept"]: r["s"] for r in got.collect()} == {
        "7": 7,
        " 7 ": 7,
        "2.5": None,
        "1e3": None,
        "": None,
        "abc": None,
        "99999999999": None,
        "true": None,
        None: None,
    }


def test_values_that_do_not_cast_fail_when_strict(casts):
    strict = clean(casts, ["convert_types"], {"convert_types": {"s": "int"}}, {"convert_types": {"on_error": "fail"}})
    with pytest.raises(PySparkException):
        strict.collect()


def test_lost_values_are_counted_along_the_way(casts):
    seen, step = Observation(), ConvertTypes({"convert_types": {"s": "int"}})
    assert step.transform(step.count_lost(casts, seen)).count() == 9
    assert seen.get == {"s": 6}


def test_conversion_to_nested_types(spark):
    df = spark.createDataFrame([(["1", "x"],)], "a array<string>")
    assert rows(clean(df, ["convert_types"], {"convert_types": {"a": "array<int>"}})) == [([1, None],)]


def test_text(spark):
    texts = ["  Ab  C ", "\tTab\t", "ÀÉÎ", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = clean(df, ["normalize_text"], {"normalize_text": "x"})
    assert [r["x"] for r in got.collect()] == ["ab  c", "\ttab\t", "àéî", "", None]


def test_timestamps(spark):
    texts = ["2024-01-02 03:04:05", "2024-1-1 1:2:3", "2024-01-02 03:04:05.5", " 2024-01-02 03:04:05"]
    texts += ["2024-02-30 00:00:00", "bad", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = clean(df, ["normalize_timestamp"], {"normalize_timestamp": {"input_col": "t"}})
    assert got.schema["t"].dataType.simpleString() == "timestamp"
    values = [r["t"] for r in got.select(F.col("t").cast("timestamp_ntz").alias("t")).collect()]
    assert values == [datetime.datetime(2024, 1, 2, 3, 4, 5)] + [None] * 6
    strict = NormalizeTimestamp({"normalize_timestamp": {"input_col": "t"}}, on_error="fail").transform(df)
    with pytest.raises(PySparkException):
        strict.collect()


@pytest.mark.parametrize(
    ("step", "section"),
    [
        ("remove_duplicates", {"subset_cols": ["nope"]}),
        ("remove_nulls", {"subset_cols": ["nope"]}),
        ("convert_types", {"nope": "int"}),
        ("null_handling", {"nope": 1}),
        ("normalize_text", ["nope"]),
        ("normalize_timestamp", {"input_col": "nope"}),
        ("lemmatize", {"key": "id", "text": "nope", "dictionary": "d"}),
    ],
)
def test_missing_columns_are_named(spark, step, section):
    with pytest.raises(ValueError, match="nope"):
        clean(spark.range(1), [step], {step: section})
    with pytest.raises(ValueError, match="nope"):
        build_pipeline([step], {step: section}).fit(spark.range(1)).transform(spark.range(1))


@pytest.mark.parametrize("step", list(STEPS))
def test_every_step_wants_a_dataframe_and_takes_an_empty_section(spark, step):
    with pytest.raises(ValueError, match="DataFrame"):
        clean([1], [step], {})
    stage = STEPS[step]({})
    with pytest.raises(ValueError, match="DataFrame"):
        stage.fit([1]) if hasattr(stage, "fit") else stage.transform([1])
    assert clean(spark.range(3), [step], {step: None}).count() == 3


def test_which_steps_run_on_streams(spark):
    stream = spark.readStream.format("rate").load()
    contract = {
        "convert_types": {"value": "string"},
        "remove_nulls": None,
        "normalize_text": ["value"],
        "normalize_timestamp": {"input_col": "value"},
        "null_handling": {"value": 0},
    }
    assert clean(stream, list(contract), contract).isStreaming
    with pytest.raises(ValueError, match="deduplicate the table"):
        clean(stream, ["remove_duplicates"], {})


def test_unknown_steps_are_found_before_any_runs(spark):
    with pytest.raises(ValueError, match="'what', 'else'"):
        clean(spark.range(1), ["remove_duplicates", "what", "else"], {})
    with pytest.raises(ValueError, match="on_error"):
        ConvertTypes({}, on_error="shrug")


def test_the_order_of_steps_matters(spark):
    df = spark.createDataFrame([("7",), (" 7",)], "s string")
    contract = {"convert_types": {"s": "int"}}
    assert clean(df, ["remove_duplicates", "convert_types"], contract).count() == 2
    assert clean(df, ["convert_types", "remove_duplicates"], contract).count() == 1


class Doubled(Step):
    section_name = "doubled"

    def apply(self, df):
        return df.withColumns({n: F.col(n) * 2 for n in self.rules})


def test_own_steps(spark):
    register_step("doubled", Doubled)
    try:
        assert rows(clean(spark.range(2), ["doubled"], {"doubled": ["id"]})) == [(0,), (2,)]
    finally:
        del STEPS["doubled"]
    with pytest.raises(ValueError, match="Transformer"):
        register_step("nothing", object)


def test_fitted_pipelines_can_be_saved(spark, nulls):
    contract = {
        "remove_duplicates": None,
        "convert_types": {"i": "double"},
        "null_handling": {"i": "mean", "d": "median", "x": "none"},
        "normalize_text": ["x"],
    }
    model = build_pipeline(list(contract), contract).fit(nulls)
    path = scratch_path(spark, "model")
    model.write().save(path)
    again = PipelineModel.load(path)
    assert rows(again.transform(nulls)) == rows(model.transform(nulls)) == rows(clean(nulls, list(contract), contract))


def test_pipelines_can_be_saved_before_they_are_fitted(spark, nulls):
    contract = {"null_handling": {"d": "median"}, "remove_duplicates": {"subset_cols": ["i"], "order_by": ["d", "x"]}}
    options = {"null_handling": {"exact_median": True, "on_empty": "keep"}}
    pipe, path = build_pipeline(list(contract), contract, options), scratch_path(spark, "pipeline")
    pipe.write().save(path)
    again = Pipeline.load(path)
    assert [type(s) for s in again.getStages()] == [HandleNulls, RemoveDuplicates]
    assert again.getStages()[0].getOrDefault("exactMedian") is True
    assert rows(again.fit(nulls).transform(nulls)) == rows(pipe.fit(nulls).transform(nulls))


def test_columns_named_like_the_library_s_own_stay(spark):
    df = spark.createDataFrame([(1, 2, 3.0, 9), (1, 3, None, 9)], "k int, position int, learnt double, `group` int")
    rules = {"remove_duplicates": {"subset_cols": ["k"], "order_by": ["position"]}, "null_handling": {"learnt": "mean"}}
    got = clean(df, list(rules), rules)
    assert got.columns == df.columns and [tuple(r) for r in got.collect()] == [(1, 2, 3.0, 9)]


def test_lost_values_are_counted(spark):
    df = spark.createDataFrame([("1", "2024-01-01 00:00:00"), ("x", "bad"), (None, None)], "n string, t string")
    rules = {"convert_types": {"n": "int"}, "normalize_timestamp": {"input_col": "t", "format": "yyyy-MM-dd HH:mm:ss"}}
    lost = {}
    clean(df, list(rules), rules, lost=lost).collect()
    assert {step: seen.get for step, seen in lost.items()} == {"convert_types": {"n": 1}, "normalize_timestamp": {"t": 1}}
