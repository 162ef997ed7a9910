"""Spelling variants among words, by partition-and-enumerate signatures of their letters.

A word's letters, with how often it has each, are a set: a vector of zeros and ones. Words that differ by one letter
put in, left out or replaced differ in at most two places of it. The places are dealt into parts; two differences
leave all parts but two alike, so that a signature for each choice of the others, the letters in them, is one that
such words share. They are joined by equal signatures, and then compared letter by letter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.scratch import scratch_path

#: Places that one edit can change.
DIFFERENT = 2
#: Parts that the places are dealt into.
PARTS = 5
#: One edit leaves the first or the last so many letters as they are.
END = 3
#: Letters dealt by how often they occur; a language has fewer.
DEALT = 512
#: Distinct words that a task counts before it hands the counts on.
HELD = 1 << 18

_LOWER = {i: i + 32 for i in range(65, 91)}

Change = Callable[[str | None, str], str]


def count_words(df: DataFrame, key: str, text: str, least: int = 7, change: Change | None = None) -> DataFrame:
    """``word`` and ``n``, how often it occurs in all whole texts, of words of at least ``least`` letters.

    Words are the longest runs of ``A-Z a-z`` and U+00C0 to U+00FF, with A-Z as a-z. ``change`` may alter them, given
    the row's key as text (null for null) and the word: it must give the same for the same, and lengthen none. Null,
    empty and blank texts have none. Repeated rows count each time; other columns are left out.
    """
    run = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counts() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for name, value in zip(*batch.columns):
                said = value.as_py() or ""
                own = Counter(run.findall(said.lower() if said.isascii() else said.translate(_LOWER)))
                if change:
                    name = name.as_py()
                    for word, n in own.items():
                        if len(word := change(name, word)) >= least:
                            held[word] += n
                else:
                    held.update(own)
                if len(held) >= HELD:
                    yield counts()
                    held.clear()
        if held:
            yield counts()

    rows = df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _dealt(words: DataFrame) -> dict[str, int]:
    """Letters to parts, so that each part has its share of frequent ones."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    often = letters.orderBy(F.desc("count"), "letter").limit(DEALT).collect()
    return {r.letter: i % PARTS if i // PARTS % 2 else PARTS - 1 - i % PARTS for i, r in enumerate(often)}


def signatures(word: str, dealt: dict[str, int]) -> list[int]:
    """What words at one edit from this one have one of: hashes of the letters in all parts but two, each with the
    first and with the last letters. A word too short to have both apart goes by its letters alone, too."""
    parts: list[list[str]] = [[] for _ in range(PARTS)]
    for letter in sorted(word):
        parts[dealt[letter] if letter in dealt else ord(letter) % PARTS].append(letter)
    ends = [f"<{word[:END]}", f">{word[-END:]}"] if len(word) >= 2 * END else []
    if len(word) <= 2 * END:
        ends.append("")
    said = ["".join(p) for p in parts]
    out = []
    for kept in combinations(range(PARTS), PARTS - DIFFERENT):
        projected = "/".join(f"{p}{said[p]}" for p in kept)
        for end in ends:
            hashed = blake2b(f"{projected}{end}".encode("utf-8", "surrogatepass"), digest_size=8)
            out.append(int.from_bytes(hashed.digest(), "little", signed=True))
    return out


def near_words(words: DataFrame) -> DataFrame:
    """Each word at one edit from another, both ways: ``word``, ``other`` and the other's ``other_n``.

    ``words`` has ``word``, each once, and ``n``. A signature that many words share is a join's hot key, which adaptive
    execution splits; what is joined is compared there and then, and only true pairs go on.
    """
    dealt = _dealt(words)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 2000):
                piece = batch.slice(part, 2000)
                signed = [signatures(w, dealt) for w in piece.column(0).to_pylist()]
                arrays = [*piece.columns, pa.array(signed, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["word", "n", "signed"])

    known = words.select("word", F.col("n").cast("long").alias("n")).where("word IS NOT NULL")
    signed = known.mapInArrow(sign, "word string, n long, signed array<long>")
    rows = signed.select("word", "n", F.explode("signed").alias("signature"))
    others = rows.select(F.col("word").alias("other"), F.col("n").alias("other_n"), "signature")
    close = F.abs(F.length("word") - F.length("other")) <= 1
    alike = (F.col("word") < F.col("other")) & close & (F.levenshtein("word", "other", 1) == 1)
    pairs = rows.join(others, (rows["signature"] == others["signature"]) & alike).select("word", "n", "other", "other_n")
    pairs = pairs.distinct()
    back = F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return pairs.select(F.inline(F.array(F.struct("word", "other", "other_n"), back)))


def spelling_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """Words with the spelling that each is taken for: ``word``, ``n``, ``form``, ``form_n``, ``root``, ``n_near``.

    ``words`` has ``word``, each once, and ``n``, how often it occurs, 1 or more; other columns are left out, as are null
    words. Words are near if one code point put in, left out or replaced makes one the other; ``n_near`` counts them. The
    near word with the largest ``n``, of equals the first in the order of code points, is the ``form`` if it occurs at
    least ``ratio`` (2 or more) times as often, else ``form`` and ``form_n`` are null. ``root`` is where forms lead to
    in the end: the word itself if it has none. Words may have any length and letters; an empty table gives none.
    """
    if ratio < 2:
        raise ValueError("a form must occur at least twice as often")
    spark = words.sparkSession
    folder = scratch_path(spark, "spelling")

    def write(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    known = write(words.select("word", F.col("n").cast("long").alias("n")).where("word IS NOT NULL"), "words")
    first = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("first")
    near = near_words(known).groupBy("word").agg(F.count("*").alias("n_near"), first)
    told = known.join(near, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
    taken = -F.col("first.less") >= ratio * F.col("n")
    formed = write(
        told.select(
            "word", "n", "n_near", F.when(taken, F.col("first.other")).alias("form"), F.when(taken, -F.col("first.less")).alias("form_n")
        ),
        "forms",
    )
    # Each step to a form multiplies the count, which bounds the steps.
    most, steps = formed.agg(F.max("form_n")).first()[0] or 0, 0
    while most >= ratio:
        most, steps = most // ratio, steps + 1
    forms = formed.where("form IS NOT NULL").select("word", "form")
    ends = forms.withColumnRenamed("form", "root")
    for _ in range(steps - 1):
        next_ = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
        ends = ends.join(next_, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    whole = formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return whole.select("word", "n", "form", "form_n", "root", "n_near")
