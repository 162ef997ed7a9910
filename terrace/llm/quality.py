"""Quality: cumulative-link regression on graded ratings over hashed text and statistics of its words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.hashing import Features, Grams, Rows, minimise, sigmoid
from terrace.functions import unused_name
from terrace.llm.sampling import ROWS_PER_LABEL, fit_in_one_task, labelled_sample

GRAMS = Grams(sizes=(1, 2, 3), bits=16, fold_case=False)

#: Shares are told apart by these edges, and numbers of words by powers of two up to 2 ** 15.
EDGES = (0.0, 0.01, 0.03, 0.1, 0.2, 0.4, 0.7)
WIDTH = (1 << GRAMS.bits) + 6 * 16

_SYMBOL = re.compile(r"[#*$%&|<>!]")
_CAPITAL = re.compile(r"[A-Z]")


def features(text: str | None) -> Features:
    """The whole text's n-grams, which share a length of one so that long texts do not outweigh short ones, and
    a bucket of value one for each statistic of its words and lines."""
    text = text or ""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, letters = max(1, len(words)), max(1, len(text))
    shares = (
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(words)) / n if words else 0.0,
        1 - len(set(lines)) / max(1, len(lines)) if lines else 0.0,
        len(_CAPITAL.findall(text)) / letters,
        min(1.0, len(_SYMBOL.findall(text)) / n),
    )
    buckets = [sum(share > edge for edge in EDGES) for share in shares] + [min(15, n.bit_length())]
    plain = [(1 << GRAMS.bits) + 16 * i + b for i, b in enumerate(buckets)]
    grams, _ = GRAMS.of(text)
    values = np.append(np.full(len(grams), 1 / np.sqrt(max(1, len(grams)))), np.ones(len(plain)))
    return np.append(grams, plain).astype(np.uint32), values.astype(np.float32)


def fit_ordinal(
    rows: Rows, grades: np.ndarray, top: int, penalty: float = 1e-4
) -> tuple[np.ndarray, np.ndarray]:
    """Weights by bucket, shared by all grades, and ``top`` rising thresholds.

    P(grade >= k) is the logistic function of the text's weight less threshold k, for k of 1 to ``top``. The
    thresholds are a first one and positive steps, kept positive by fitting their logarithms. Grades count the
    same however many rows they have; one without rows gets the smallest step.
    """
    counts = np.bincount(grades, minlength=top + 1)
    each = (1 / (np.count_nonzero(counts) * counts[grades])).astype(float)

    def thresholds(t: np.ndarray) -> np.ndarray:
        return t[0] + np.append(0, np.cumsum(np.exp(t[1:])))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, t = x[: rows.width], x[rows.width :]
        cuts = np.concatenate([[-np.inf], thresholds(t), [np.inf]])
        z = rows.times(w)
        above, below = sigmoid(z - cuts[grades]), sigmoid(z - cuts[grades + 1])
        share = np.maximum(above - below, 1e-12)
        d_above, d_below = above * (1 - above), below * (1 - below)
        by_z = -each * (d_above - d_below) / share
        by_cut = np.zeros(top + 2)
        np.add.at(by_cut, grades, each * d_above / share)
        np.add.at(by_cut, grades + 1, -each * d_below / share)
        by_cut = by_cut[1:-1]
        by_t = np.append(by_cut.sum(), [by_cut[k:].sum() * np.exp(t[k]) for k in range(1, top)])
        value = -(each @ np.log(share)) + penalty / 2 * (w @ w) + 1e-3 / 2 * (t[1:] @ t[1:])
        return value, np.concatenate([rows.transposed_times(by_z) + penalty * w, by_t + np.append(0, 1e-3 * t[1:])])

    x = minimise(loss, np.zeros(rows.width + top))
    return x[: rows.width].astype(np.float32), thresholds(x[rows.width :]).astype(np.float32)


def train_quality(
    docs: DataFrame, grades: DataFrame, key: str, text: str, grade: str, top: int, rows: int = ROWS_PER_LABEL, told: dict | None = None
) -> bytes:
    """A model of grades 0 to ``top`` by text, fitted to all of a sample of at most ``rows`` rows of each grade.

    Thresholds first, then weights: 256 kB whatever the corpus. Null grades and keys teach nothing; a null text
    is an empty one. Without rows of two grades at least, every text gets the grade there is, or the top one. ``told``
    is given, as ``rows``, how many rows taught.
    """

    def fit(taught: list[Features], known: list[int]) -> bytes:
        if len(set(known)) < 2:
            only = known[0] if known else top
            cuts, weights = np.where(np.arange(1, top + 1) <= only, -20.0, 20.0), np.zeros(WIDTH)
        else:
            weights, cuts = fit_ordinal(Rows.of(taught, WIDTH), np.array(known), top)
        return np.concatenate([cuts, weights]).astype("<f4").tobytes()

    y = unused_name(docs, "label")
    sample = labelled_sample(docs.select(key, text), grades, key, grade, list(range(top + 1)), rows)
    return fit_in_one_task(sample.withColumnRenamed("label", y), text, y, features, fit, told)


def grade_quality(
    df: DataFrame, text: str, model: bytes, top: int, at_least: int, least_probability: float = 0.5
) -> DataFrame:
    """Adds ``expected_grade``, ``tail_probability`` (of grade ``at_least`` or more) and ``kept`` to every row.

    ``kept`` holds where the tail probability is ``least_probability`` or more. Each whole text counts; a null
    text is graded as an empty one; equal texts are graded the same; columns of these three names are replaced,
    all others stay. No shuffle.
    """
    df = df.drop("expected_grade", "tail_probability", "kept")
    sent = df.sparkSession.sparkContext.broadcast(model)

    def grades(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(sent.value, "<f4").astype(float)
        cuts, weights = known[:top], known[top:]
        for batch in batches:
            expected, tail = [], []
            for value in batch.column(len(batch.columns) - 1):
                buckets, values = features(value.as_py())
                above = sigmoid(weights[buckets] @ values - cuts)
                expected.append(float(above.sum()))
                tail.append(float(above[at_least - 1]) if at_least else 1.0)
            columns = [*batch.columns[:-1], pa.array(expected, pa.float64()), pa.array(tail, pa.float64())]
            names = [*batch.schema.names[:-1], "expected_grade", "tail_probability"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    copy = unused_name(df, "copy")
    schema = df.schema.add("expected_grade", "double").add("tail_probability", "double")
    graded = df.withColumn(copy, F.col(text)).mapInArrow(grades, schema)
    return graded.withColumn("kept", F.col("tail_probability") >= least_probability)
