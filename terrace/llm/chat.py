"""Conversations, rendered by a template."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame

from terrace.llm.templates import CHAT, compile_template

FORMATTED = "formatted string, loss_spans array<struct<start: long, stop: long>>"


def format_chats(df: DataFrame, conversation: str, turn: str, role: str, text: str, template: str = CHAT) -> DataFrame:
    """A row per conversation: its key, ``formatted``, and ``loss_spans`` (where the template generates).

    Rows of a conversation are in the order of ``turn``, then of role and text; repeated rows are turns of their
    own. Null roles and texts are empty; null keys are one conversation. Other columns are left out, and an empty
    table gives none. One shuffle brings the turns of a conversation together in order; a task then holds one
    conversation at a time, which its formatted text takes anyway.
    """
    key_type = df.schema[conversation].dataType
    rows = (
        df.select(df[conversation].alias("key"), df[turn].alias("turn"), df[role].alias("role"), df[text].alias("text"))
        .repartition("key")
        .sortWithinPartitions("key", "turn", "role", "text")
        .select("key", "role", "text")
    )

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, held, kind, size = compile_template(template), [], None, 0
        spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

        def first(batches):
            nonlocal kind
            for batch in batches:
                kind = kind or batch.schema.field(0).type
                yield batch

        def full() -> pa.RecordBatch:
            keys, texts, marks = zip(*held)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, kind), pa.array(texts, pa.string()), pa.array(marks, spans)],
                names=["key", "formatted", "loss_spans"],
            )

        for key, turns in groupby(stream(first(batches)), key=itemgetter(0)):
            done, marks = run({"messages": [{"role": r or "", "text": t or ""} for _, r, t in turns]})
            held.append((key, done, [{"start": a, "stop": b} for a, b in marks]))
            size += len(done)
            if size >= 1 << 22 or len(held) >= 5000:
                yield full()
                held, size = [], 0
        if held:
            yield full()

    out = rows.mapInArrow(render, f"key {key_type.simpleString()}, {FORMATTED}")
    return out.withColumnRenamed("key", conversation)
