"""Small files of closed batches become larger ones, and nothing else changes."""

import os
from collections import Counter, defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from terrace import Bronze, Silver, compact_bronze, read_table, run_bronze, run_silver
from terrace.streaming import compaction
from terrace.streaming.compaction import fill_bins

SCHEMA = {"columns": [{"name": "id"}, {"name": "part"}]}
PARTS = ("01", "a b/c", "", "x=%2F")


@pytest.fixture
def job(tmp_path, database):
    (tmp_path / "in").mkdir()
    return Bronze(f"{database}.t", str(tmp_path / "in"), str(tmp_path / "out"), SCHEMA, partitions=["part"])


def deliver(spark, job, tmp_path, numbers):
    for n in numbers:
        lines = [f"{n}-{p},{p}" for p in PARTS] + [f"same,{PARTS[0]}"]
        (tmp_path / "in" / f"{n}.csv").write_text("\n".join(["id,part", *lines]) + "\n")
        run_bronze(spark, job)


def wanted(numbers):
    return Counter([(f"{n}-{p}", p or None) for n in numbers for p in PARTS] + [("same", PARTS[0])] * len(numbers))


def rows(spark, job):
    return Counter((r.id, r.part) for r in read_table(spark, job.table).select("id", "part").collect())


def files(tmp_path):
    return sorted(f"{at}/{f}" for at, _, names in os.walk(tmp_path / "out" / "t" / "data") for f in names if f.endswith(".parquet"))


@given(st.lists(st.integers(0, 100), max_size=60), st.integers(10, 120))
def test_bins_are_full_but_not_too_full(sizes, room):
    held = defaultdict(list)
    for size, b in zip(sizes, fill_bins(sizes, room)):
        held[b].append(size)
    assert sorted(held) == list(range(len(held)))
    assert all(sum(b) <= room or (max(b) > room and sum(b) == max(b)) for b in held.values())
    light = [b for b in held.values() if 2 * sum(b) <= room]
    assert len(light) <= 1 or not any(any(b) for b in light[1:])


def test_closed_batches_become_one(spark, job, tmp_path):
    deliver(spark, job, tmp_path, range(5))
    newest = [f for f in files(tmp_path) if "ingest_batch=4" in f]
    assert compact_bronze(spark, job) == {"files_before": 16, "files_after": 4}
    assert len(files(tmp_path)) == 4 + len(newest) and set(newest) < set(files(tmp_path))
    assert rows(spark, job) == wanted(range(5))
    assert {r.ingest_batch for r in read_table(spark, job.table).select("ingest_batch").collect()} == {"3", "4"}
    # Readers of the folders see the same, and a table made anew too.
    assert spark.read.parquet(str(tmp_path / "out" / "t" / "data")).count() == 25
    spark.sql(f"DROP TABLE {job.table}")
    deliver(spark, job, tmp_path, [5])
    assert rows(spark, job) == wanted(range(6))
    assert compact_bronze(spark, job)["files_after"] == 4 and rows(spark, job) == wanted(range(6))
    assert compact_bronze(spark, job) == {"files_before": 0, "files_after": 0}


def test_bins_and_large_files(spark, job, tmp_path):
    deliver(spark, job, tmp_path, range(4))
    size = max(map(os.path.getsize, files(tmp_path)))
    assert compact_bronze(spark, job, target=size // 2) == {"files_before": 0, "files_after": 0}  # all are large enough
    got = compact_bronze(spark, job, target=int(2.5 * size))
    assert got == {"files_before": 12, "files_after": 8} and rows(spark, job) == wanted(range(4))


def test_no_task_sorts_what_it_rewrites(spark, job, tmp_path, monkeypatch):
    """Rows written by partition columns would be sorted by them, all of a bin in the memory of one task."""
    real, written = compaction._rewritten, []
    monkeypatch.setattr(compaction, "_rewritten", lambda *args: written.append(real(*args)) or written[0])
    deliver(spark, job, tmp_path, range(4))
    size = max(map(os.path.getsize, files(tmp_path)))
    assert compact_bronze(spark, job, target=int(2.5 * size)) == {"files_before": 12, "files_after": 8}
    assert written[0].columns == ["id"] and rows(spark, job) == wanted(range(4))


def test_nothing_to_do(spark, job, tmp_path):
    nothing = {"files_before": 0, "files_after": 0}
    assert compact_bronze(spark, job) == nothing
    deliver(spark, job, tmp_path, [0])
    assert compact_bronze(spark, job) == nothing
    deliver(spark, job, tmp_path, [1, 2])
    assert compact_bronze(spark, job, through=0) == nothing
    assert rows(spark, job) == wanted(range(3))


@pytest.mark.parametrize("step, at", [("add_commit", 0), ("remove_folder", 1), ("move_folder", 0), ("replace_partitions", 0), ("add_commit", 1)])
def test_a_lost_run_is_finished_by_the_next(spark, job, tmp_path, monkeypatch, step, at):
    deliver(spark, job, tmp_path, range(4))
    real, calls = getattr(compaction, step), []

    def fails(*args, **kwargs):
        calls.append(1)
        if len(calls) > at:
            raise OSError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(compaction, step, fails)
    with pytest.raises(OSError):
        compact_bronze(spark, job)
    monkeypatch.setattr(compaction, step, real)
    compact_bronze(spark, job)
    assert rows(spark, job) == wanted(range(4)) and len(files(tmp_path)) == 8
    deliver(spark, job, tmp_path, [4])
    assert rows(spark, job) == wanted(range(5))


def test_a_clean_table_by_batch_goes_on(spark, job, tmp_path, database):
    silver = Silver(
        f"{database}.clean", job.table, str(tmp_path / "clean"), {"remove_duplicates": {"subset_cols": ["id"], "order_by": ["part"]}},
        steps=["remove_duplicates"], schema=SCHEMA, buckets=4,
    )
    deliver(spark, job, tmp_path, range(3))
    run_silver(spark, silver)
    deliver(spark, job, tmp_path, [3])
    compact_bronze(spark, job, through=2)
    run_silver(spark, silver)
    compact_bronze(spark, job)
    run_silver(spark, silver)
    assert silver.rewritten == []
    assert Counter((r.id, r.part) for r in read_table(spark, silver.table).select("id", "part").collect()) == Counter(set(wanted(range(4))))


def test_a_file_that_was_not_planned_stops_the_run(spark, tmp_path):
    spark.range(3).selectExpr("CAST(id AS STRING) AS id", "'0' AS ingest_batch").write.partitionBy("ingest_batch").parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    with pytest.raises(Exception, match="no such file in the plan"):
        compaction._rewritten(rows, ["ingest_batch"], [("0", "other.parquet", "0", 0)], 1).collect()
