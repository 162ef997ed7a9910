"""op9: documents that contain benchmark items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.llm.contamination import SEPARATORS, find_contamination
from terrace.llm.registry import query, table
from terrace.llm.words import LOWER, UPPER

_WORDS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^{SEPARATORS}]+')"


@query(f"""
WITH docs AS (SELECT doc_id, coalesce({_WORDS}, []) AS words FROM documents),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark WHERE len({_WORDS}) > 0),
item_windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[p:p + least(len(words), 10) - 1], ' ') AS said
  FROM items, LATERAL (SELECT unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS p)),
doc_windows AS (
  SELECT doc_id, size, p, array_to_string(words[p:p + size - 1], ' ') AS said
  FROM docs, (SELECT DISTINCT size FROM item_windows), LATERAL (SELECT unnest(range(1, len(words) - size + 2)) AS p)),
found AS (SELECT doc_id, size, p, item_id FROM doc_windows JOIN item_windows USING (size, said)),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM found, LATERAL (SELECT unnest(range(p, p + size)) AS place) GROUP BY doc_id),
names AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN names USING (doc_id)
""")
def op9_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return find_contamination(docs, "text", table(spark, sf, "benchmark"), "item_id", "text")
