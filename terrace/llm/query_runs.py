"""op13: periodic runs of words in documents, a tenth of which are made periodic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.registry import query, table
from terrace.llm.runs import collapse_runs
from terrace.llm.words import split_words

_SPACE = r"\x20\x09-\x0D"


def made_periodic(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; where crc32 of the id's decimals, h, is divisible by 10, with words that repeat.

    Of the n words there, each from the a-th on is the one of the first p from there that its place asks for, where
    a = g % n, p = 1 + (n - a) div (3 + g % 8) and g = h div 10. A null id or a text without words changes nothing.
    """
    hashed = F.crc32(F.col("doc_id").cast("string"))
    chosen = documents.select("doc_id", "text", hashed.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, split_words(F.col("text"), _SPACE))
    )
    sized = chosen.select("*", F.size("words").alias("n"), F.floor(F.col("h") / 10).alias("g"))
    placed = sized.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    a, p = F.col("a"), F.col("p")
    at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
    said = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", at(i))), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, said).otherwise(F.col("text")).alias("text"))


def greatest_exponent(runs: str) -> Column:
    """The run of the greatest length in periods, the first of such; exact, by cross-multiplication."""

    def better(best: Column, run: Column) -> Column:
        return F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best)

    rest = F.slice(runs, 2, F.size(runs))
    return F.when(F.size(runs) > 0, F.aggregate(rest, F.get(runs, F.lit(0)), better))


@query(r"""
WITH bits AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
hashed AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
         xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(doc_id::VARCHAR) + 1),
               lambda i: ascii(substring(doc_id::VARCHAR, i, 1))::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM documents, bits),
placed AS (SELECT *, len(w) AS n, h // 10 AS g FROM hashed),
based AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM placed),
periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM based),
said AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
  FROM periods),
words AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM said),
alike AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM words x JOIN words y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM alike),
stretches AS (SELECT doc_id, q, min(i) AS "start", count(*) + q AS length FROM islands GROUP BY doc_id, q, island
              HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT doc_id, "start", length, min(q) AS period FROM stretches GROUP BY doc_id, "start", length),
told AS (SELECT doc_id, count(*) AS n_runs,
                string_agg("start" || ',' || length || ',' || period || chr(10), '' ORDER BY "start", period) AS said
         FROM runs GROUP BY doc_id),
compared AS (SELECT r.*, (SELECT count(*) FROM runs o WHERE o.doc_id = r.doc_id AND (o.length * r.period > r.length * o.period
               OR o.length * r.period = r.length * o.period AND (o."start", o.period) < (r."start", r.period))) AS better FROM runs r),
dropped AS (SELECT DISTINCT doc_id, unnest(range("start" + period, "start" + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest FROM words w ANTI JOIN dropped d USING (doc_id, i) GROUP BY doc_id)
SELECT s.doc_id, coalesce(n_runs, 0) AS n_runs, c."start" AS "start", c.length AS length, c.period AS period,
       1000 * c.length // c.period AS exponent_milli, sha256(coalesce(t.said, '')) AS runs_sha256,
       sha256(coalesce(rest, '')) AS collapsed_sha256
FROM said s LEFT JOIN told t USING (doc_id) LEFT JOIN compared c ON c.doc_id = s.doc_id AND c.better = 0
LEFT JOIN kept k ON k.doc_id = s.doc_id
""")
def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = collapse_runs(made_periodic(table(spark, sf, "documents")), "text")
    best = found.withColumn("best", greatest_exponent("runs"))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{n}").alias(n) for n in ("start", "length", "period")],
        F.expr("1000 * best.length DIV best.period AS exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
