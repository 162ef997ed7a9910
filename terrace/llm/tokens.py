"""Token ids of whole texts, and their pieces."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Fixed value of byte-level BPE: how it cuts text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Letters, digits and signs whose kind all Unicode versions agree on: Latin and general punctuation.
_PLAIN = re.compile(r"[^\x00-ɏ‐-‧‰-⁞€]")

#: The fast library goes back over a run of white space and overflows its stack at about a million characters.
LONG_RUN = 100_000
_LONG_SPACE = re.compile(rf"(?<!\s)\s{{{LONG_RUN}}}")


def _byte_of() -> dict[str, int]:
    """Byte-level BPE's letter for each byte: printable ones stand for themselves, the rest follow at 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Ids:
    """Ids of texts by a byte-level BPE tokenizer's file, special tokens in texts included, none added.

    The file's vocabulary runs in a second library too, which is several times as fast and gives the same ids
    where both know each letter's kind; texts with other letters, special tokens or very long runs of white space
    go through the first.
    """

    def __init__(self, path: str):
        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = _byte_of()
        self.special = [t["content"] for t in content["added_tokens"]]
        vocabulary = content["model"]["vocab"].items()
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary if t not in self.special}
        self.fast = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> list[int]:
        spaced = len(text) >= LONG_RUN and _LONG_SPACE.search(text)
        if spaced or _PLAIN.search(text) or any(t in text for t in self.special):
            return self.full.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


PIECES = "part int, rank long, piece int, start long, length int, ids_crc32 long"


def token_pieces(df: DataFrame, key: str, text: str, path: str, end: int, capacity: int) -> DataFrame:
    """A row per piece of each row's ids: those of the whole text, then ``end``.

    Ids longer than ``capacity`` are cut into pieces of it, and the first piece has what is over. ``part`` and
    ``rank`` number the pieces of a length that one task makes, from 0: with the counts of each part they number
    all pieces, once the rows are written. ``path`` names a file on every executor. Null texts are empty, and
    repeated rows have pieces of their own.
    """
    known = df.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, part = Ids(path), TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                some = batch.slice(at, 256)
                for name, value in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    found = np.array([*ids.of(value or ""), end], "<u4")
                    first = len(found) % capacity or capacity
                    edges = [0, *range(first, len(found) + 1, capacity)]
                    for i, (a, b) in enumerate(zip(edges, edges[1:])):
                        rows.append((name, part, int(met[b - a]), i, a, b - a, zlib.crc32(found[a:b].tobytes())))
                        met[b - a] += 1
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), [batch.schema.field(0).type, *_TYPES])]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, f"key {known}, {PIECES}").withColumnRenamed("key", key)


_NAMES = ["key", "part", "rank", "piece", "start", "length", "ids_crc32"]
_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
