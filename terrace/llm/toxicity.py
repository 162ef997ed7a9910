"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.hashing import Features, Grams, Rows, minimise, sigmoid
from terrace.functions import unused_name
from terrace.llm.sampling import ROWS_PER_LABEL, fit_in_one_task, labelled_sample

GRAMS = Grams(sizes=(3, 5, 7), bits=18, fold_case=True)

#: A false alarm counts as so many misses where the score's middle is set.
ALARM = 5.0


def features(text: str | None) -> Features:
    """The whole text's n-grams; a value is the root of the n-gram's share of all, so that all texts have length
    one and what comes often counts for more, but not in proportion."""
    buckets, met = GRAMS.of(text)
    return buckets, np.sqrt(met / max(1, met.sum())).astype(np.float32)


def log_count_ratios(rows: Rows, labels: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """By bucket, how much likelier it is among rows of label 1 than among those of label 0, as a logarithm."""
    ones, zeros = smoothing + rows.counts(labels), smoothing + rows.counts(1 - labels)
    return np.log(ones / ones.sum()) - np.log(zeros / zeros.sum())


def fit_weights(rows: Rows, labels: np.ndarray, penalty: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights by bucket, ratios included, and a constant; both classes count the same."""
    ratios = log_count_ratios(rows, labels)
    each = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    sign = 2 * labels - 1

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        margin = sign * (rows.times(x[:-1] * ratios) + x[-1])
        value = each @ np.logaddexp(0, -margin) + penalty / 2 * (x[:-1] @ x[:-1])
        pull = -each * sign * sigmoid(-margin)
        slope = np.append(rows.transposed_times(pull) * ratios + penalty * x[:-1], pull.sum())
        return value, slope

    x = minimise(loss, np.zeros(rows.width + 1))
    return (x[:-1] * ratios).astype(np.float32), float(x[-1])


def _middle(margins: np.ndarray, labels: np.ndarray) -> float:
    """Where to cut margins of rows that a fit has not seen, for the fewest misses and false alarms: the middle
    of the widest among the best places."""
    order = np.argsort(margins, kind="stable")
    ranked, y = margins[order], labels[order]
    missed = np.append(0, np.cumsum(y)) / max(1, y.sum())
    alarms = np.append(np.cumsum((1 - y)[::-1])[::-1], 0) / max(1, (1 - y).sum())
    cost = missed + ALARM * alarms
    ends = np.concatenate([[ranked[0] - 1], ranked, [ranked[-1] + 1]])
    gaps = np.where(cost <= cost.min() + 1e-9, ends[1:] - ends[:-1], -1)
    best = int(gaps.argmax())
    return float((ends[best] + ends[best + 1]) / 2)


def _fit(rows: list[Features], labels: list[int]) -> bytes:
    """Constant first, then weights. Without rows of both labels the score is the share of label 1.

    A second fit without each fourth row, and its margins for these, tell where the score's middle belongs.
    """
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        share = min(max(float(y.mean()) if labels else 0.0, 1e-6), 1 - 1e-6)
        return np.append(np.log(share / (1 - share)), np.zeros(1 << GRAMS.bits)).astype("<f4").tobytes()
    width, fold = 1 << GRAMS.bits, np.arange(len(y)) % 4 == 0
    weights, constant = fit_weights(Rows.of(rows, width), y)
    if all(len({*y[part]}) == 2 for part in (fold, ~fold)):
        learned, start = fit_weights(Rows.of([r for r, f in zip(rows, fold) if not f], width), y[~fold])
        unseen = Rows.of([r for r, f in zip(rows, fold) if f], width).times(learned) + start
        constant -= _middle(unseen, y[fold])
    return np.append(constant, weights).astype("<f4").tobytes()


def train_toxicity(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int = ROWS_PER_LABEL, told: dict | None = None
) -> bytes:
    """A model of label 0 or 1 by text, fitted to all of a sample of at most ``rows`` rows of each label.

    A model is 1 MB whatever the corpus. Null labels and keys teach nothing; a null text is an empty one. ``told`` is
    given, as ``rows``, how many rows taught.
    """
    y = unused_name(docs, "label")
    sample = labelled_sample(docs.select(key, text), labels, key, label, [0, 1], rows).withColumnRenamed("label", y)
    return fit_in_one_task(sample, text, y, features, _fit, told)


def score_toxicity(df: DataFrame, text: str, model: bytes, score: str = "score") -> DataFrame:
    """Adds the probability of label 1, between 0 and 1, of every whole text.

    A null text scores as an empty one; equal texts score the same; a column of that name is replaced, all others
    stay. No shuffle.
    """
    df = df.drop(score)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(sent.value, "<f4").astype(float)
        constant, weights = known[0], known[1:]
        for batch in batches:
            found = []
            for value in batch.column(len(batch.columns) - 1):
                buckets, values = features(value.as_py())
                found.append(float(sigmoid(weights[buckets] @ values + constant)))
            columns = [*batch.columns[:-1], pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], score])

    copy = unused_name(df, "copy")
    schema = df.schema.add(score, "double")
    return df.withColumn(copy, F.col(text)).mapInArrow(scores, schema)
