"""Bounded samples of labelled rows, and models fitted to them in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions import unused_name
from terrace.llm.hashing import Features, pack, unpack

#: What a fit takes at most: so many rows of each label. A task then holds 8 bytes for each of their features.
ROWS_PER_LABEL = 1500


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str, label: str, values: list[int], rows: int = ROWS_PER_LABEL
) -> DataFrame:
    """The documents of up to ``rows`` labelled rows of each label, in the order of a hash of the key.

    Which rows there are to choose from comes from joining the keys alone; their number bounds the keys that are
    then broadcast to the documents. Of several documents with a chosen key that whose columns' hash is smallest is
    taken, so that ``rows`` bounds documents too.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).where(
        F.col("key").isNotNull() & F.col("label").isNotNull()
    )
    there = known.join(docs.select(F.col(key).alias("key")), "key", "left_semi")
    order = [F.xxhash64("key"), "key", "label"]
    chosen = reduce(
        DataFrame.unionByName, [there.where(F.col("label") == v).orderBy(*order).limit(rows) for v in values]
    )
    chosen = chosen.groupBy("key").agg(F.max("label").alias("label"))
    rank = unused_name(docs, "rank")
    first = Window.partitionBy("key").orderBy(F.xxhash64(*docs.columns))
    found = docs.withColumn("key", F.col(key)).join(F.broadcast(chosen), "key")
    return found.withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).drop("key", rank)


def fit_in_one_task(
    sample: DataFrame,
    text: str,
    label: str,
    features: Callable[[str | None], Features],
    fit: Callable[[list[Features], list[int]], bytes],
    told: dict[str, int] | None = None,
) -> bytes:
    """What ``fit`` makes, in one task, of the features and labels of a bounded sample: all of its rows.

    Texts become features where they are; these meet in one task, which takes them in the order of a hash of
    their bytes. ``told`` is given, as ``rows``, how many there were.
    """

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pack(features(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1)], names=["x", "y"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys = [], []
        for batch in batches:
            xs += [unpack(x) for x in batch.column(0).to_pylist()]
            ys += batch.column(1).to_pylist()
        model, rows = pa.array([fit(xs, ys)], pa.binary()), pa.array([len(ys)], pa.int64())
        yield pa.RecordBatch.from_arrays([model, rows], names=["model", "rows"])

    rows = sample.select(F.col(text), F.col(label).cast("int").alias("y")).mapInArrow(prepare, "x binary, y int")
    ordered = rows.repartition(1).sortWithinPartitions(F.xxhash64("x"), "y")
    fitted = ordered.mapInArrow(train, "model binary, rows long").first()
    if told is not None:
        told["rows"] = fitted["rows"] if fitted else 0
    return bytes(fitted["model"]) if fitted else fit([], [])  # no task runs over no rows
