"""op1: near copies among documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.llm.near_copies import near_copies
from terrace.llm.registry import query, table


@query(r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles,
       least(doc_id, coalesce((SELECT min(other) FROM reached r WHERE r.doc_id = sets.doc_id), doc_id)) AS component_id
FROM sets
""")
def op1_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return near_copies(table(spark, sf, "documents"), "doc_id", "text", n=4, percent=85)
