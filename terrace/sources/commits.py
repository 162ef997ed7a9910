"""Small numbered files beside a table that tell what it holds."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def make_folder(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.mkdirs(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def full_path(spark: SparkSession, path: str) -> str:
    """The path as files below it are named: with its scheme, and the folder that a relative one starts from."""
    files, place = _place(spark, path)
    return files.makeQualified(place).toString().rstrip("/")


def file_exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name, which nothing has yet."""
    files, place = _place(spark, path)
    target = _place(spark, to)[1]
    if files.exists(target) or not files.rename(place, target):
        raise RuntimeError(f"{path} could not be moved to {to}")


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """The names of the files right below a folder."""
    files, place = _place(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(place) if f.isFile())


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    files, place = _place(spark, folder)
    if not files.exists(place):
        return []
    names = [f.getPath().getName() for f in files.listStatus(place)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def last_commit(spark: SparkSession, folder: str) -> tuple[int, dict[str, Any]]:
    """The newest file's number and content; 0 and nothing where there is none."""
    numbers = _numbers(spark, folder)
    if not numbers:
        return 0, {}
    text = spark.read.text(f"{folder}/{numbers[-1]}.json", wholetext=True).first()[0]
    return numbers[-1], json.loads(text)


def add_commit(spark: SparkSession, folder: str, number: int, content: dict[str, Any]) -> None:
    """Write the file of that number, whole or not at all; all but it and the one before go.

    Somebody else's file of that number is an error: two jobs must not keep one table.
    """
    files, _ = _place(spark, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    final, draft = path(f"{folder}/{number}.json"), path(f"{folder}/.draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    if files.exists(final) or not files.rename(draft, final):
        files.delete(draft, False)
        raise RuntimeError(f"another job has written {final}")
    for old in _numbers(spark, folder):
        if old < number - 1:
            files.delete(path(f"{folder}/{old}.json"), False)
