"""Records that do not fit, kept apart."""

import pytest

from terrace import Bronze, append_new, read_new_files, read_table, register_source, run_bronze, schema_from_dict
from terrace.sources.files import SOURCES
from terrace.streaming.append import write_batch

SCHEMA = {"columns": [{"name": n} for n in ("id", "part", "note")]}


def ingest(spark, home, database, kind, content, **job):
    (home / "in").mkdir(exist_ok=True)
    name = f"{len(list((home / 'in').iterdir()))}.{kind}"
    (home / "in" / name).write_text(content)
    bronze = Bronze(f"{database}.t", str(home / "in"), str(home / "out"), SCHEMA, kind, quarantine=True, **job)
    run_bronze(spark, bronze)
    rows = sorted((tuple(r) for r in read_table(spark, f"{database}.t").select("id", "part", "note").collect()), key=repr)
    bad = read_table(spark, f"{database}.t_rejected")
    assert bad.columns == ["file", "text", "reason", "ingest_date", "ingest_batch"]
    told = sorted((r.file.rsplit("/", 1)[1], r.text, r.reason) for r in bad.collect())
    return rows, told


def test_csv(spark, tmp_path, database):
    content = 'id,part,note\n1,x,"a,b"\n2,x\n3,x,c,d\n\n,,\n4,"y",\n'
    rows, told = ingest(spark, tmp_path, database, "csv", content, partitions=["part"])
    assert rows == [("1", "x", "a,b"), ("4", "y", None), (None, None, None)]
    assert told == [("0.csv", "2,x", "not 3 fields"), ("0.csv", "3,x,c,d", "not 3 fields")]
    rows, told = ingest(spark, tmp_path, database, "csv", "id,part,note\n5,z,e\n6\n", partitions=["part"])
    assert len(rows) == 4 and told[-1] == ("1.csv", "6", "not 3 fields") and len(told) == 3


def test_json(spark, tmp_path, database):
    content = '{"id": 1, "note": {"a": [1, 2]}}\n{"id": 2\nnonsense\n{"other": 1}\n\n{"id": "3", "part": null}\n'
    rows, told = ingest(spark, tmp_path, database, "json", content)
    assert rows == [("1", None, '{"a": [1, 2]}'), ("3", None, None), (None, None, None)]
    assert told == [("0.json", "nonsense", "not a JSON object"), ("0.json", '{"id": 2', "not a JSON object")]


def test_json_over_several_lines(spark, tmp_path, database):
    rows, told = ingest(spark, tmp_path, database, "json", '[{"id": 1},\n {"id": 2}]', reader={"multiline": True})
    assert [r[0] for r in rows] == ["1", "2"] and told == []
    rows, told = ingest(spark, tmp_path, database, "json", '[{"id": 3},\n {"id": ', reader={"multiline": True})
    assert len(told) == 1 and told[0][1] == '[{"id": 3},\n {"id": '


def test_text(spark, tmp_path, database):
    rows, told = ingest(spark, tmp_path, database, "text", "1|x|\n2|x\n\n3|x|y|z\n", reader={"delimiter": "|"})
    assert rows == [("1", "x", "")]
    assert told == [("0.text", "", "1 pieces, not 3"), ("0.text", "2|x", "2 pieces, not 3"), ("0.text", "3|x|y|z", "4 pieces, not 3")]


def test_nothing_rejected_and_nothing_else(spark, tmp_path, database):
    assert ingest(spark, tmp_path, database, "csv", "id,part,note\n1,x,y\n") == ([("1", "x", "y")], [])
    rows, told = ingest(spark, tmp_path, database, "csv", "id,part,note\n1\n2\n")
    assert len(rows) == 1 and len(told) == 2


def test_a_batch_written_again_replaces_both(spark, tmp_path, database):
    ingest(spark, tmp_path, database, "csv", "id,part,note\n1,x,y\n2\n")
    home = f"{tmp_path}/out/t"
    for place, table in ((f"{home}/data", f"{database}.t"), (f"{home}/rejected", f"{database}.t_rejected")):
        write_batch(read_table(spark, table).drop("ingest_batch"), 0, place, ["ingest_date", "ingest_batch"], "parquet", "s")
        assert read_table(spark, table).count() == 1


def test_what_cannot_be_told(spark, tmp_path):
    schema = schema_from_dict(SCHEMA)
    (tmp_path / "in").mkdir()
    told = read_new_files(spark, "csv", str(tmp_path / "in"), schema, quarantine=True)
    plain = read_new_files(spark, "csv", str(tmp_path / "in"), schema)
    for stream, place in ((told, None), (plain, f"{tmp_path}/q")):
        with pytest.raises(ValueError, match="place"):
            append_new(stream, f"{tmp_path}/d", f"{tmp_path}/c", quarantine=place)
    with pytest.raises(ValueError, match="of their own"):
        read_new_files(spark, "csv", str(tmp_path / "in"), schema_from_dict({"columns": [{"name": "Rejected"}]}), quarantine=True)
    register_source("orc", lambda reader, path, schema, options: reader.schema(schema).orc(path))
    try:
        with pytest.raises(ValueError, match="do not fit"):
            read_new_files(spark, "orc", str(tmp_path / "in"), schema, quarantine=True)
    finally:
        del SOURCES["orc"]
