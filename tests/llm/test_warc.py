import base64
import hashlib

import zstandard
from pyspark.sql import functions as F

from terrace.llm.shared_files import open_file
from terrace.llm.warc import DICTIONARY_FRAME, read_archives, read_records, with_revisits, write_archives
from terrace.scratch import scratch_path


def archived(spark, rows, least=0):
    df = spark.createDataFrame(rows, "page_id long, url string, payload binary").withColumn("digest", F.lit("mine"))
    marked = with_revisits(df, "page_id", "payload", least)
    assert "digest" in marked.columns and "first_key" not in marked.columns
    folder = scratch_path(spark, "warc-test")
    write_archives(marked, f"{folder}/a", "page_id", "url", "payload").write.parquet(f"{folder}/m")
    manifest = spark.read.parquet(f"{folder}/m")
    return manifest, read_archives(manifest, 3).collect()


ROWS = [
    (1, "http://a\r\nX: y", b"same"), (2, None, b"same"), (3, "u%0A", b"same"), (4, "u", b""), (5, "u", b""), (6, "", b"WARC/1.1\r\n\r\nbody"),
    (7, "u", bytes(range(256)) * 4000), (None, "null key", b"alone"), (3, "again", b"same"), (8, "é", "é".encode()),
]


def test_round_trip(spark):
    _, back = archived(spark, ROWS)
    assert len(back) == len(ROWS)
    by = {(r["record_id"], r["url"]): r for r in back}
    for key, url, payload in ROWS:
        r = by[("" if key is None else str(key)), url]
        assert r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        same = [k for k, _, p in ROWS if p == payload and k is not None]
        if key is not None and key < max(same):
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", str(max(same)), None)
        else:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, payload)


def test_null_payloads_are_empty_ones(spark):
    _, back = archived(spark, [(1, "u", None), (2, "u", b""), (3, "u", None)])
    got = sorted((r["record_id"], r["record_type"], r["payload_bytes"], r["refers_to"]) for r in back)
    assert got == [("1", "revisit", 0, "3"), ("2", "revisit", 0, "3"), ("3", "response", 0, None)]


def test_least_bytes(spark):
    _, back = archived(spark, ROWS, least=1)
    assert all(r["record_type"] == "response" for r in back if r["payload_bytes"] == 0)


def test_dictionary_leads_the_archive_and_serves_every_record(spark):
    rows = [(i, f"http://h/{i}", f"<html><body><p>page {i} says hello to page {i * 7}</p></body></html>".encode() * 5) for i in range(3000)]
    manifest, back = archived(spark, rows)
    assert sorted(int(r["record_id"]) for r in back) == list(range(3000))
    for r in manifest.collect():
        with open_file(r["archive"]) as file:
            data = file.read()
        assert data[:4] == DICTIONARY_FRAME
        size = int.from_bytes(data[4:8], "little")
        known = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        assert zstandard.get_frame_parameters(data[8 + size :]).dict_id == known.dict_id() != 0
        assert len(list(read_records(r["archive"]))) == r["records"]


def test_empty_table(spark):
    manifest, back = archived(spark, [])
    assert back == [] and manifest.count() == 0
