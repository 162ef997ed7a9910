"""op2 and op4: documents scored by models of their labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.quality import grade_quality, train_quality
from terrace.llm.registry import query, table
from terrace.llm.toxicity import score_toxicity, train_toxicity

#: Grades from the labels: 0 for junk, 1 for sound but toxic, 2 for sound text.
TOP_GRADE = 2


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> bytes:
    taught = labels.where(~held_out(F.col("doc_id")))
    return train_toxicity(docs, taught, "doc_id", "text", "toxic")


def graded(labels: DataFrame) -> DataFrame:
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, TOP_GRADE)
    return labels.select("doc_id", grade.alias("grade"))


@query()
def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, "text", toxicity_model(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op4_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Grades of all documents, by a model that learns like op2's from labels that are not held out."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    taught = graded(table(spark, sf, "labels")).where(~held_out(F.col("doc_id")))
    model = train_quality(docs, taught, "doc_id", "text", "grade", TOP_GRADE)
    rated = grade_quality(docs, "text", model, TOP_GRADE, at_least=1)
    return rated.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail_probability", "kept"
    )
