import json

import pytest
import yaml

from terrace import Bronze, Gold, Silver, read_table, run_bronze, run_layers, run_silver
from terrace.__main__ import main
from terrace.plans.jobs import load_jobs

COLUMNS = ["gauge", "river", "keeper", "level", "bank"]
SCHEMA = {"columns": [{"name": n} for n in COLUMNS]}
CONTRACT = """
remove_duplicates: {subset_cols: }
remove_nulls: {subset_cols: [keeper, level]}
convert_types: {gauge: integer, level: string}
null_handling: {river: unnamed}
normalize_text: [river, keeper]
"""
READINGS = """gauge,river,keeper,level,bank
1, Isar ,Moser,3.5,L
1, Isar ,Moser,3.5,L
2,,Huber,2,R
x,Inn,,4,R
"""


@pytest.fixture
def jobs(tmp_path, database):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "readings.csv").write_text(READINGS)
    (tmp_path / "schema.json").write_text(json.dumps(SCHEMA))
    (tmp_path / "contract.yaml").write_text(CONTRACT)
    raw = Bronze(
        f"{database}_raw.readings",
        str(tmp_path / "in"),
        str(tmp_path / "bronze"),
        str(tmp_path / "schema.json"),
        partitions=["bank"],
    )
    silver = Silver(
        f"{database}_clean.readings", raw.table, str(tmp_path / "silver"), str(tmp_path / "contract.yaml"), schema=SCHEMA
    )
    gold = Gold(
        f"{database}_features.bank",
        str(tmp_path / "gold"),
        ["bank"],
        {silver.table: [{"strategy": "entity_aggregates", "columns": {"gauge": ["max"]}, "rows": "readings"}]},
    )
    return raw, silver, gold


def test_default_steps(spark, jobs):
    raw, silver, _ = jobs
    run_bronze(spark, raw)
    run_silver(spark, silver)
    got = read_table(spark, silver.table)
    assert got.columns == COLUMNS and got.schema["gauge"].dataType.simpleString() == "int"
    assert sorted(map(tuple, got.select("gauge", "river", "keeper").collect()), key=repr) == [
        (1, " Isar ", "Moser"),
        (2, "unnamed", "Huber"),
        (None, "Inn", None),
    ]


def test_rows_that_came_on_two_days_are_duplicates(spark, jobs, tmp_path):
    raw, silver, _ = jobs
    run_bronze(spark, raw)
    data = tmp_path / "bronze" / "readings" / "data"
    assert len(list(data.glob("ingest_date=*"))) == 1
    (tmp_path / "in" / "again.csv").write_text(READINGS)
    run_bronze(spark, raw)
    assert read_table(spark, raw.table).count() == 8
    run_silver(spark, silver)
    assert read_table(spark, silver.table).count() == 3


def test_a_contract_is_checked_before_anything_is_written(spark, jobs, tmp_path):
    raw, silver, _ = jobs
    run_bronze(spark, raw)
    silver.contract = {"convert_types": {"nope": "int"}}
    with pytest.raises(ValueError, match="nope"):
        run_silver(spark, silver)
    assert not (tmp_path / "silver").exists()


def test_all_layers(spark, jobs):
    raw, silver, gold = jobs
    silver.steps = ["remove_duplicates", "remove_nulls", "convert_types", "null_handling", "normalize_text"]
    tables = run_layers(spark, {"bronze": [raw], "silver": [silver], "gold": [gold]})
    assert tables == [raw.table, silver.table, gold.table]
    assert sorted(map(tuple, read_table(spark, silver.table).select("gauge", "river", "keeper").collect())) == [
        (1, "isar", "moser"),
        (2, "unnamed", "huber"),
    ]
    assert sorted(map(tuple, read_table(spark, gold.table).collect())) == [("L", 1, 1), ("R", 1, 2)]
    assert run_layers(spark, {"silver": [silver]}, ["silver"]) == [silver.table]
    with pytest.raises(ValueError, match="platinum"):
        run_layers(spark, {}, ["platinum"])


def test_jobs_from_a_file(spark, jobs, tmp_path):
    raw, silver, gold = ({**vars(job)} for job in jobs)
    path = tmp_path / "jobs.yaml"
    silver["steps"] = list(silver["steps"])
    path.write_text(yaml.safe_dump({"bronze": [raw], "silver": [silver], "gold": [gold]}))
    tables = [job.table for job in jobs]
    assert main([str(path), "bronze"]) == tables[:1]
    assert main([str(path)]) == tables
    assert sorted(map(tuple, read_table(spark, tables[2]).collect()), key=repr) == [("L", 1, 1), ("R", 2, 2)]
    path.write_text("platinum: []")
    with pytest.raises(ValueError, match="platinum"):
        load_jobs(str(path))
    with pytest.raises(SystemExit):
        main([])
