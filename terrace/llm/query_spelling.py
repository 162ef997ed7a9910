"""op12: spelling variants of words in documents, some of which lose a letter."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame, SparkSession

from terrace.llm.registry import query, table
from terrace.llm.spelling import count_words, spelling_variants


def lose_a_letter(key: str | None, word: str) -> str:
    """The word, without one letter where 31 divides the crc32 of key and word; a null key counts as empty."""
    h = crc32(f"{key or ''}:{word}".encode())
    if h % 31:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


@query(r"""
WITH RECURSIVE bits AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
runs AS (SELECT doc_id, run, count(*) AS n, doc_id || ':' || run AS said FROM found WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (
  SELECT *, flatten(list_transform(range(1, length(said) + 1), lambda i:
    CASE WHEN unicode(substring(said, i, 1)) < 128 THEN [unicode(substring(said, i, 1))::BIGINT]
         ELSE [195::BIGINT, unicode(substring(said, i, 1))::BIGINT - 64] END)) AS b FROM runs),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], b),
                                             lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h FROM bytes, bits),
damaged AS (
  SELECT n, CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
shorter AS (SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest FROM places),
near AS (
  SELECT DISTINCT word, other, other_n FROM (
    SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION ALL SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
    UNION ALL SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place,
                  count(*) OVER (PARTITION BY word) AS n_near FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= 10 * w.n THEN r.other END AS form,
         CASE WHEN r.other_n >= 10 * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
path AS (
  SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL SELECT p.word, f.form, steps + 1 FROM path p JOIN formed f ON f.word = p.root WHERE f.form IS NOT NULL)
SELECT f.word, form, (SELECT arg_max(root, steps) FROM path p WHERE p.word = f.word) AS root, n, n_near, form_n FROM formed f
""")
def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    words = count_words(table(spark, sf, "documents"), "doc_id", "text", 7, lose_a_letter).where("n >= 2")
    return spelling_variants(words, ratio=10).select("word", "form", "root", "n", "n_near", "form_n")
