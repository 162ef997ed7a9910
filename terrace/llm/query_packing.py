"""op7: documents packed into sequences of tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terrace.llm.packing import pack_pieces
from terrace.llm.registry import query, table
from terrace.llm.tokens import token_pieces
from terrace.scratch import scratch_path

CAPACITY, END = 1024, 2


def packed(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """A row per piece of the documents' ids, with its place; the pieces are written once in between."""
    path = scratch_path(spark, "pieces")
    file = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    token_pieces(docs, "doc_id", "text", str(file), END, CAPACITY).write.parquet(path)
    placed = pack_pieces(spark.read.parquet(path), CAPACITY)
    columns = [placed[c].cast("long") if c in ("start", "length") else placed[c] for c in placed.columns]
    return placed.select(*columns)


@query()
def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packed(spark, table(spark, sf, "documents").select("doc_id", "text"))
