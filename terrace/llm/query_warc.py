"""op10: pages to archives and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.registry import query, table
from terrace.llm.warc import read_archives, with_revisits, write_archives
from terrace.scratch import scratch_path

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Writes the pages' archives under ``folder``, with a table that lists them; gives that table."""
    rows = pages.select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    )
    marked = with_revisits(rows, "page_id", "payload")
    write_archives(marked, f"{folder}/archives", "page_id", "url", "payload").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


@query(f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT hex, max(page_id) AS first FROM p GROUP BY hex)
SELECT page_id, strlen(payload) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', 1 + (
         (('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '')
         AS payload_digest,
       CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < first THEN first END AS refers_to
FROM p JOIN firsts USING (hex)
""")
def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    manifest = archive_pages(spark, table(spark, sf, "pages"), scratch_path(spark, "warc"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    back = read_archives(manifest, tasks, with_payload=False)
    return back.select(
        F.expr("CAST(nullif(record_id, '') AS BIGINT)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.expr("CAST(refers_to AS BIGINT)").alias("refers_to"),
    )
