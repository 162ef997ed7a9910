"""Fills learnt from what each batch left."""

import random

import pytest

from terrace import Bronze, Silver, append_new, build_pipeline, read_new_files, read_table, run_bronze, run_silver
from terrace.operators.batch_statistics import fills_from, statistics_of, write_statistics
from terrace.operators.nulls import HandleNulls

CONTRACT = {
    "convert_types": {"a": "decimal(10,2)", "b": "int", "c": "double"},
    "null_handling": {"a": "mean", "b": "median", "c": "mean", "d": "none"},
}
KINDS = {"a": "mean", "b": "median", "c": "mean"}


def raw(spark, rows):
    return spark.createDataFrame(rows, "a string, b string, c string, d string")


def test_batches_merge_to_what_all_rows_give(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"{rng.randint(0, 999) / 100}", str(rng.randint(0, 10_000)), rng.choice(["NaN", "x", None, "1.5", "2"]), "y") for _ in range(3000)]
    place = str(tmp_path / "s")
    write_statistics(raw(spark, rows[:10]), 0, place, CONTRACT)
    write_statistics(raw(spark, rows[1000:]).repartition(5), 1, place, CONTRACT)
    write_statistics(raw(spark, rows[:1000]), 0, place, CONTRACT)  # the batch again, whole this time
    typed = build_pipeline(["convert_types"], CONTRACT).fit(raw(spark, rows)).transform(raw(spark, rows))
    got = fills_from(spark, place, KINDS, {n: typed.schema[n].dataType for n in KINDS})
    want = HandleNulls(CONTRACT).fit(typed).getOrDefault("learned")
    assert {n: got[n] for n in ("a", "c")} == {n: want[n] for n in ("a", "c")}
    assert abs(sum(int(r[1]) < int(got["b"]) for r in rows) / len(rows) - 0.5) < 0.01


def test_no_row_is_read_for_a_fill(spark, tmp_path):
    place = str(tmp_path / "s")
    write_statistics(raw(spark, [("1", "5", "2", "x"), ("2", "7", None, "x"), ("3", "9", "4", None)]), 0, place, CONTRACT)
    typed = spark.createDataFrame([(None, None, None, None)], "a decimal(10,2), b int, c double, d string")
    filled = HandleNulls(CONTRACT, statistics=place).fill_in_one_plan(typed)
    assert tuple(map(str, filled.first())) == ("2.00", "7", "3.0", "none")
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Subquery" not in plan


def test_nothing_to_learn(spark, tmp_path):
    place = str(tmp_path / "s")
    write_statistics(raw(spark, [(None, "x", "NaN", None)]), 0, place, CONTRACT)
    write_statistics(raw(spark, []), 1, place, CONTRACT)
    df = spark.createDataFrame([(None, None, None, None)], "a decimal(10,2), b int, c double, d string")
    with pytest.raises(ValueError, match="a, b, c"):
        HandleNulls(CONTRACT, statistics=place).fit(df)
    kept = HandleNulls(CONTRACT, statistics=place, on_empty="keep").fit(df).transform(df)
    assert tuple(kept.first()) == (None, None, None, "none")
    with pytest.raises(ValueError, match="exact"):
        HandleNulls(CONTRACT, statistics=place, exact_median=True)
    with pytest.raises(ValueError, match="is string"):
        statistics_of(raw(spark, []), {"null_handling": {"d": "median"}})
    with pytest.raises(ValueError, match="no such column"):
        fills_from(spark, place, {"e": "mean"}, {})


def test_jobs_keep_and_use_them(spark, tmp_path, database):
    (tmp_path / "in").mkdir()
    schema = {"columns": [{"name": n} for n in "abcd"]}
    bronze = Bronze(f"{database}.raw", str(tmp_path / "in"), str(tmp_path / "bronze"), schema, statistics=CONTRACT)
    for i, rows in enumerate(["1,2,3,x\n3,4,,\n", "5,,5,y\n,9,NaN,\n"]):
        (tmp_path / "in" / f"{i}.csv").write_text("a,b,c,d\n" + rows)
        run_bronze(spark, bronze)
    options = {"null_handling": {"statistics": f"{tmp_path}/bronze/raw/statistics"}}
    silver = Silver(f"{database}.clean", bronze.table, str(tmp_path / "clean"), CONTRACT, ["convert_types", "null_handling"], schema, options)
    run_silver(spark, silver)
    rows = sorted(tuple(map(str, r)) for r in read_table(spark, silver.table).select(*"abcd").collect())
    assert rows == [("1.00", "2", "3.0", "x"), ("3.00", "4", "4.0", "none"), ("3.00", "9", "4.0", "none"), ("5.00", "4", "5.0", "y")]


def test_fills_on_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.csv").write_text("a,b,c,d\n,,,\n")
    place = str(tmp_path / "s")
    write_statistics(raw(spark, [("1", "5", "2", "x")]), 0, place, CONTRACT)
    from terrace import schema_from_dict

    stream = read_new_files(spark, "csv", str(tmp_path / "in"), schema_from_dict({"columns": [{"name": n} for n in "abcd"]}))
    typed = build_pipeline(["convert_types"], CONTRACT).fit(raw(spark, [])).transform(stream)
    filled = HandleNulls(CONTRACT, statistics=place).fit(typed).transform(typed)
    append_new(filled, f"{tmp_path}/d", f"{tmp_path}/c", ingest_date=None)
    assert tuple(map(str, spark.read.parquet(f"{tmp_path}/d").select(*"abcd").first())) == ("1.00", "5", "2.0", "none")
