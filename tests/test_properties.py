import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from terrace import append_new, clean, read_new_files, schema_from_dict

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "i int, d double, x string"
NUMBERS = st.one_of(st.none(), st.floats(allow_infinity=False, width=32))
TEXTS = st.one_of(st.none(), st.sampled_from([" a", "A ", "b"]))
ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), NUMBERS, TEXTS), max_size=12)


def rows(df):
    return sorted(map(repr, df.collect()))


def missing(v):
    return v is None or (isinstance(v, float) and math.isnan(v))


@FEW
@given(data=ROWS)
def test_steps_do_all_they_can_the_first_time(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    for step, section in [("remove_duplicates", None), ("remove_nulls", None), ("normalize_text", ["x"])]:
        once = clean(df, [step], {step: section})
        assert rows(clean(once, [step], {step: section})) == rows(once)


@FEW
@given(data=ROWS)
def test_removed_and_filled_nulls_are_gone(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    assert not any(missing(v) for r in clean(df, ["remove_nulls"], {}).collect() for v in r)
    rules, options = {"i": "mean", "d": "median", "x": "?"}, {"on_empty": "keep"}
    kept = clean(df, ["null_handling"], {"null_handling": rules}, {"null_handling": options})
    for i, values in enumerate(zip(*kept.collect(), strict=True)):
        learnt = i == 2 or any(not missing(r[i]) for r in data)
        assert not learnt or not any(map(missing, values))
    assert kept.count() == len(data)


@FEW
@given(data=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=200))
def test_the_approximate_median_is_within_one_percent_of_rank(spark, data):
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "d double")
    filled = clean(df.withColumn("was", df.d), ["null_handling"], {"null_handling": {"d": "median"}})
    median = filled.where("was IS NULL").first()["d"]
    less, up_to = sum(v < median for v in data), sum(v <= median for v in data)
    assert less <= 0.51 * len(data) + 1 and up_to >= 0.49 * len(data) - 1


@pytest.mark.parametrize("runs", [[3], [1, 2], [0, 1, 0, 2]])
def test_files_land_once_however_the_runs_fall(spark, tmp_path, runs):
    source, schema = tmp_path / "in", schema_from_dict({"columns": [{"name": "id"}]})
    source.mkdir()
    done = 0
    for n in runs:
        for i in range(done, done + n):
            (source / f"{i}.csv").write_text(f"id\n{i}\n")
        done += n
        stream = read_new_files(spark, "csv", str(source), schema)
        assert append_new(stream, f"{tmp_path}/d", f"{tmp_path}/c", ingest_date=None) == n
    assert sorted(r["id"] for r in spark.read.schema(schema).parquet(f"{tmp_path}/d").collect()) == ["0", "1", "2"]
