"""The catalog learns of new batches, and looks at no others."""

import pytest

from terrace import Bronze, read_table, run_bronze
from terrace.sources import tables

SCHEMA = {"columns": [{"name": "id"}, {"name": "part"}]}


@pytest.fixture
def job(tmp_path, database):
    (tmp_path / "in").mkdir()
    return Bronze(f"{database}.t", str(tmp_path / "in"), str(tmp_path / "out"), SCHEMA, partitions=["part"])


def deliver(spark, job, tmp_path, number, parts=("x", "a b/c", "")):
    lines = [f"{number}-{p},{p}" for p in parts]
    (tmp_path / "in" / f"{number}.csv").write_text("\n".join(["id,part", *lines]) + "\n")
    run_bronze(spark, job)


def test_statements_and_listings_do_not_grow_with_batches(spark, job, tmp_path, monkeypatch):
    stated, listed = [], []
    run, look = tables._run, tables._listed
    monkeypatch.setattr(tables, "_run", lambda spark, s: stated.append(s) or run(spark, s))
    monkeypatch.setattr(tables, "_listed", lambda spark, p: listed.append(p) or look(spark, p))
    counts = []
    for n in range(6):
        stated.clear(), listed.clear()
        deliver(spark, job, tmp_path, n)
        counts.append((len(stated), len(listed)))
        if n:
            assert not any("MSCK" in s for s in stated)
    assert len(set(counts[1:])) == 1
    rows = {(r.id, r.part) for r in read_table(spark, job.table).select("id", "part").collect()}
    assert rows == {(f"{n}-{p}", p or None) for n in range(6) for p in ("x", "a b/c", "")}
    assert len({r.ingest_batch for r in read_table(spark, job.table).select("ingest_batch").collect()}) == 6


def test_a_run_lost_before_the_catalog_is_made_good(spark, job, tmp_path, monkeypatch):
    deliver(spark, job, tmp_path, 0)
    run = tables._run

    def fails(spark, statement):
        raise OSError("lost")

    monkeypatch.setattr(tables, "_run", fails)
    with pytest.raises(OSError):
        deliver(spark, job, tmp_path, 1)
    monkeypatch.setattr(tables, "_run", run)
    assert read_table(spark, job.table).count() == 3
    run_bronze(spark, job)
    assert read_table(spark, job.table).count() == 6
    deliver(spark, job, tmp_path, 2)
    assert read_table(spark, job.table).count() == 9


def test_a_table_of_before_gets_its_mark(spark, job, tmp_path):
    deliver(spark, job, tmp_path, 0)
    spark.sql(f"ALTER TABLE {job.table} UNSET TBLPROPERTIES ('{tables.LAST_BATCH}')")
    deliver(spark, job, tmp_path, 1)
    deliver(spark, job, tmp_path, 2)
    assert read_table(spark, job.table).count() == 9
    spark.sql(f"DROP TABLE {job.table}")
    run_bronze(spark, job)
    assert read_table(spark, job.table).count() == 9


def test_another_place_is_an_error(spark, job, tmp_path):
    deliver(spark, job, tmp_path, 0)
    job.base_path = str(tmp_path / "elsewhere")
    with pytest.raises(ValueError, match="is at"):
        run_bronze(spark, job)
