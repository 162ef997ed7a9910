import pytest
from pyspark.sql import functions as F

from terrace import overwrite_table, read_table, register
from terrace.functions import quote_table
from terrace.sources.tables import _details, _same_place


def test_names():
    assert quote_table("a.b.c") == "`a`.`b`.`c`"
    assert quote_table("a`b") == "`a``b`"
    for bad in ("", "a..b", "a.b.c.d"):
        with pytest.raises(ValueError):
            quote_table(bad)


def test_places():
    same = [("/a b/c", "file:/a b/c/"), ("file:///a", "file:/a"), ("/a", "hdfs://n:1/a"), ("s3a://x/a", "s3a://x/a/")]
    for a, b in same:
        assert _same_place(a, b) and _same_place(b, a)
    for a, b in [("/a", "/b"), ("s3a://x/a", "s3a://y/a"), ("s3a://x/a", "file:/a"), ("hdfs://n/a", "hdfs://n/a/b")]:
        assert not _same_place(a, b)


def test_register_creates_database_and_table(spark, tmp_path, database):
    spark.range(3).write.parquet(str(tmp_path / "it's here"))
    name = f"spark_catalog.{database}.t"
    for _ in range(2):
        assert register(spark, name, str(tmp_path / "it's here")) == name
    assert spark.table(f"{database}.t").count() == 3
    spark.range(2).write.mode("append").parquet(str(tmp_path / "it's here"))
    register(spark, f"{database}.t", str(tmp_path / "it's here"))
    assert spark.table(f"{database}.t").count() == 5


def test_a_table_elsewhere_is_not_taken_for_this_one(spark, tmp_path, database):
    for name in "ab":
        spark.range(1).write.parquet(str(tmp_path / name))
    register(spark, f"{database}.t", str(tmp_path / "a"))
    with pytest.raises(ValueError, match="not at"):
        register(spark, f"{database}.t", str(tmp_path / "b"))


def test_partition_values_keep_their_declared_type(spark, tmp_path, database):
    df = spark.createDataFrame([("1", "01"), ("2", "02"), ("3", None)], "v string, p string")
    overwrite_table(df, f"{database}.t", str(tmp_path), partitions=["p"])
    got = sorted(map(tuple, read_table(spark, f"{database}.t").collect()), key=repr)
    assert got == [("1", "01"), ("2", "02"), ("3", None)]
    assert read_table(spark, f"{database}.t", df.select("p").schema).columns == ["p"]


def test_overwrite_replaces_rows_schema_and_partitions(spark, tmp_path, database):
    name, home = f"{database}.t", str(tmp_path)
    places = [
        overwrite_table(spark.range(3), name, home),
        overwrite_table(spark.range(4), name, home),
        overwrite_table(spark.range(5).withColumn("p", F.col("id") % 2), name, home, partitions=["p"]),
        overwrite_table(spark.range(6).withColumn("p", F.col("id") % 2), name, home),
        overwrite_table(spark.range(7).limit(0), name, home),
    ]
    assert len(set(places)) == 5
    assert read_table(spark, name).count() == 0 and read_table(spark, name).columns == ["id"]
    assert [spark.read.parquet(p).count() for p in places[:4]] == [3, 4, 5, 6]
    overwrite_table(spark.range(2), name, home, table_format="orc")
    assert _details(spark, name)["Provider"] == "orc" and spark.table(name).count() == 2


def test_a_table_can_be_replaced_from_itself(spark, tmp_path, database):
    name = f"{database}.t"
    overwrite_table(spark.range(10), name, str(tmp_path))
    for left in (9, 8):
        overwrite_table(read_table(spark, name).where(F.col("id") < left), name, str(tmp_path))
    assert read_table(spark, name).count() == 8


def test_a_failed_overwrite_leaves_the_table_as_it_was(spark, tmp_path, database):
    name = f"{database}.t"
    overwrite_table(spark.range(10), name, str(tmp_path))
    broken = spark.range(10).select(F.when(F.col("id") > 5, F.raise_error(F.lit("stop")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        overwrite_table(broken, name, str(tmp_path))
    assert read_table(spark, name).count() == 10


def test_tables_that_own_their_files_are_left_alone(spark, tmp_path, database):
    spark.sql(f"CREATE DATABASE {database}")
    spark.range(3).write.saveAsTable(f"{database}.t")
    with pytest.raises(ValueError, match="owns its files"):
        overwrite_table(spark.range(1), f"{database}.t", str(tmp_path))
    assert spark.table(f"{database}.t").count() == 3


def test_unknown_formats_fail(spark, tmp_path, database):
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        overwrite_table(spark.range(1), f"{database}.t", str(tmp_path), table_format="delta")


def described(spark, name):
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner team' = 'ours')")
    spark.sql(f"COMMENT ON TABLE {name} IS 'it''s ours'")
    spark.sql(f"ALTER TABLE {name} ALTER COLUMN id COMMENT 'the key'")


@pytest.mark.parametrize("partitions", [[], ["p"]])
def test_properties_and_comments_are_kept(spark, tmp_path, database, partitions):
    name, rows = f"{database}.t", spark.range(4).withColumn("p", F.col("id") % 2)
    overwrite_table(rows, name, str(tmp_path), partitions=partitions)
    described(spark, name)
    for df in (rows, rows.withColumn("more", F.lit(1))):
        overwrite_table(df, name, str(tmp_path), partitions=partitions)
        assert ("owner team", "ours") in [tuple(r) for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()]
        assert _details(spark, name)["Comment"] == "it's ours"
        assert {c.name: c.description for c in spark.catalog.listColumns(name)}["id"] == "the key"
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["t"]


PARTED = [("1", "01"), ("2", "a/b=c d%"), ("3", None), ("4", "gone")]


def test_partitions_follow_the_files(spark, tmp_path, database):
    name = f"{database}.t"
    first = spark.createDataFrame(PARTED, "v string, p string")
    second = spark.createDataFrame([("5", "01"), ("6", "a/b=c d%"), ("7", None), ("8", "new")], first.schema)
    overwrite_table(first, name, str(tmp_path), partitions=["p"])
    overwrite_table(second, name, str(tmp_path), partitions=["p"])
    assert sorted(map(repr, read_table(spark, name).collect())) == sorted(map(repr, second.collect()))


@pytest.mark.parametrize("change", ["same", "columns", "partitions"])
@pytest.mark.parametrize("parted", [False, True])
def test_a_table_can_be_read_after_a_failure_at_any_step(spark, tmp_path, database, monkeypatch, change, parted):
    import terrace.sources.tables as tables

    old = spark.createDataFrame(PARTED[:3], "v string, p string")
    new = spark.createDataFrame([("9", "01"), ("8", "x")], "v string, p string")
    new = new.withColumn("w", F.lit(1)) if change == "columns" else new
    by = ["p"] if parted != (change == "partitions") else []
    run, done = tables._run, False
    for step in range(20):
        name, left = f"{database}_{step}.t", [step]

        def fails(spark, statement, name=name, left=left):
            assert name and spark.table(name).count() >= 0  # readable before each statement but the taking of the name
            left[0] -= 1
            if left[0] < 0:
                raise RuntimeError("lost")
            return run(spark, statement)

        def checked(spark, statement, fails=fails, left=left):
            if "_old" in statement or "__" in statement.split("RENAME")[0] and "RENAME" in statement:
                left[0] -= 1
                if left[0] < 0:
                    raise RuntimeError("lost")
                return run(spark, statement)
            return fails(spark, statement)

        overwrite_table(old, name, f"{tmp_path}/{step}", partitions=["p"] if parted else [])
        monkeypatch.setattr(tables, "_run", checked)
        try:
            overwrite_table(new, name, f"{tmp_path}/{step}", partitions=by)
            done = True
        except RuntimeError:
            pass
        monkeypatch.setattr(tables, "_run", run)
        got = {r["v"] for r in read_table(spark, name).collect()}
        assert got and got <= {"1", "2", "3", "8", "9"}
        if change != "same" or not parted:
            assert got in ({"1", "2", "3"}, {"8", "9"})
        if done:
            assert got == {"8", "9"}
            break
    assert done and step > 0
