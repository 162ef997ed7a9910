"""Documents through the operators: filters, near copies, benchmark passages, packed sequences.

Each stage takes what the one before it kept, from a table in the folder that driver and executors share. All but
the last return rows of ``documents`` as they are; the last returns where each piece of each document is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.contamination import find_contamination
from terrace.functions import unused_name
from terrace.llm.near_copies import near_copies
from terrace.llm.quality import grade_quality, train_quality
from terrace.llm.query_classifiers import TOP_GRADE, graded
from terrace.llm.query_packing import packed
from terrace.llm.registry import table
from terrace.llm.toxicity import score_toxicity, train_toxicity
from terrace.scratch import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier of a grade above junk, by a model of the labelled ones among them.

    A null text counts as an empty one. Repeated rows are judged alike, and each stays or goes; other columns, and rows
    without an id, are kept as they are. An empty table gives an empty one.
    """
    model = train_quality(docs, graded(table(spark, sf_dir, "labels")), "doc_id", "text", "grade", TOP_GRADE)
    rated = grade_quality(docs, "text", model, TOP_GRADE, at_least=1)
    return rated.where("kept").select(*docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below a half, by a model of the labelled ones among them.

    Nulls, repeated rows, other columns and empty tables are dealt with as by ``good_quality``; a column named ``score``
    is left alone.
    """
    model = train_toxicity(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    score = unused_name(docs, "score")
    return score_toxicity(docs, "text", model, score).where(F.col(score) < 0.5).select(*docs.columns)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a name for each: the id, null ones last, and a hash of the text."""
    key = unused_name(docs, "key")
    name = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), F.xxhash64("text").alias("said"))
    return docs.withColumn(key, name), key


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose sets of five-word n-grams are alike to 0.8 or more, directly or by others, that with the
    smallest id. Documents without words are alike to none. Of repeated rows one stays."""
    keyed, key = _keyed(docs)
    found = near_copies(keyed, key, "text", n=5, percent=80)
    firsts = found.where(F.col("component_id") == F.col(key)).select(key).distinct()
    return keyed.dropDuplicates([key]).join(firsts, key, "left_semi").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Null and empty texts have no words, and stay. Repeated rows stay or go together. Without items, or without documents,
    all that there are stay.
    """
    keyed, key = _keyed(docs)
    items = table(spark, sf_dir, "benchmark")
    found = find_contamination(keyed.select(key, "text"), "text", items, "item_id", "text")
    leaky = found.where("contaminated").select(key).distinct()
    return keyed.join(leaky, key, "left_anti").select(*docs.columns)


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of each document's tokens, with the sequence it is packed into.

    A null text is packed as an empty one. Each of repeated rows has its own pieces; an empty table gives no rows.
    """
    return packed(spark, docs.select("doc_id", "text"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("toxicity", not_toxic),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", in_sequences),
]

#: None, as SQL cannot express the classifiers; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    folder = scratch_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
