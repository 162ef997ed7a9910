"""op6: documents judged by rules learned from labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.registry import query, table
from terrace.llm.rules import Rule, learn_rules, verdict
from terrace.llm.statistics import text_statistics
from terrace.scratch import scratch_path

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


#: What rules are about: shares, which mean the same in short and long texts.
SHARES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeated_share": "n_repeat_words / greatest(n_words, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "repeated_lines_per_word": "n_dup_lines / greatest(n_words, 1)",
}


def with_shares(counted: DataFrame) -> DataFrame:
    return counted.withColumns({name: F.expr(share) for name, share in SHARES.items()})


def quality_rules(counted: DataFrame, labels: DataFrame) -> list[Rule]:
    """Rules for low quality, from all labelled documents that the base rule leaves."""
    known = labels.select("doc_id", F.col("quality").alias("label"))
    rows = with_shares(counted.where(~base_failed())).join(known, "doc_id")
    return learn_rules(rows.select("doc_id", *SHARES, "label"), list(SHARES), "doc_id")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@query()
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics are written once, as learning and judging read them."""
    path = scratch_path(spark, "statistics")
    text_statistics(table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text").write.parquet(path)
    counted = spark.read.parquet(path)
    rules = quality_rules(counted, table(spark, sf, "labels"))
    judged = with_shares(counted).withColumn("base_failed", base_failed())
    return judged.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & verdict(rules)).alias("kept"))
