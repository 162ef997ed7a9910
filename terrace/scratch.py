"""Where intermediate files go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_given: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the folder all executors share.

    The folder is the session's ``spark.checkpoint.dir``. Where that is unset, a local master gets
    a temporary folder; a cluster has no folder we could rightly choose, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="terrace-")
    _given.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _given[-1]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path given by ``scratch_path``, on whatever file system it is."""
    if path in _given:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _given.remove(path)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the scratch files made meanwhile: for a job whose result is written by then."""
    before = set(_given)
    try:
        yield
    finally:
        for path in [p for p in _given if p not in before]:
            remove(spark, path)
