"""Fewer and larger files for the batches of a table of ``append_new`` that are closed."""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from terrace.functions import column, unused_name
from terrace.sources.commits import (
    add_commit,
    file_exists,
    file_names,
    full_path,
    last_commit,
    make_folder,
    move_folder,
    remove_folder,
)
from terrace.sources.tables import VERSIONED, partition_directories, replace_partitions
from terrace.streaming.append import BATCH

#: Bytes that a rewritten file has at most, unless a file is larger already.
TARGET = 128 << 20
COMMITS = "_compactions"


def fill_bins(sizes: Sequence[int], room: int) -> list[int]:
    """A bin for each size, by best fit, largest first: no bin holds more than ``room``, but for a size beyond that."""
    bins: list[int] = [0] * len(sizes)
    left: list[tuple[int, int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(left, (sizes[i], -1))
        free, bins[i] = left.pop(at) if at < len(left) else (room, len(left))
        insort(left, (max(free - sizes[i], 0), bins[i]))
    return bins


def _files(spark: SparkSession, location: str, folders: Iterable[str], suffix: str) -> list[tuple[str, int]]:
    """Files below some folders, as paths from ``location``, and their sizes; listed by Spark's tasks, none is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", suffix)
    paths = [f"{location}/{f}" for f in folders]
    found = reader.load(paths).select("path", "length").collect()
    return sorted((r["path"].removeprefix(f"{location}/"), r["length"]) for r in found)


def _values(entry: str) -> list[str | None]:
    values = (level.partition("=")[2] for level in entry.split("/"))
    return [None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for v in values]


def _rewritten(rows: DataFrame, levels: Sequence[str], plan: list[tuple], bins: int) -> DataFrame:
    """The rows of the planned files without their partition columns, each bin in the task of its number."""
    name, bin_, into = (unused_name(rows, n) for n in ("file", "bin", "into"))
    keys = [f"key{i}" for i in range(len(levels) + 1)]
    schema = StructType([StructField(k, StringType()) for k in [*keys, into]]).add(bin_, "integer")
    # A row per file of this run, with a name and some numbers: the driver has listed them, so this is small.
    files = F.broadcast(rows.sparkSession.createDataFrame(plan, schema))
    named = rows.withColumn(name, F.col("_metadata.file_name"))
    same = [column(a).eqNullSafe(column(b)) for a, b in zip([*levels, name], keys)]
    met = named.join(files, reduce(lambda a, b: a & b, same), "left")
    # A file that nobody has listed would be lost with its folder.
    missing = F.raise_error(F.concat(F.lit("no such file in the plan: "), column(name)))
    first, *others = [f for f in rows.schema.fields if f.name not in levels]
    known = F.when(column(into).isNotNull(), column(first.name)).otherwise(missing.cast(first.dataType)).alias(first.name)
    return met.repartitionById(bins, F.coalesce(column(bin_), F.lit(0))).select(known, *[column(f.name) for f in others])


def _into_folders(spark: SparkSession, staged: str, folders: Sequence[str], suffix: str) -> None:
    """Move the files of the tasks that wrote them, one for each bin, to the folders of their bins.

    A bin has one value of each partition column. Written by these columns, its rows would all be sorted first.
    """
    for f in set(folders):
        make_folder(spark, f"{staged}/{f}")
    for name in file_names(spark, staged):
        if name.endswith(suffix) and not name.startswith(("_", ".")):
            task = re.match(r"part-(\d+)-", name)
            if not task or int(task[1]) >= len(folders):
                raise RuntimeError(f"no task is known to have written {staged}/{name}")
            move_folder(spark, f"{staged}/{name}", f"{staged}/{folders[int(task[1])]}/{name}")


def compact_batches(
    spark: SparkSession,
    location: str,
    schema: StructType,
    *,
    partitions: Sequence[str] = (),
    ingest_date: str | None = "ingest_date",
    table_format: str = "parquet",
    table: str | None = None,
    through: int | None = None,
    target: int = TARGET,
) -> dict[str, int]:
    """Rewrite the small files of each day's closed batches as files of up to ``target`` bytes; count both.

    All batches but the newest are closed: no replay writes them again. ``through`` closes fewer, as one who takes a
    table batch by batch must have taken what is merged (``run_silver`` has, once it has run). A day's batches become
    the last one of them; batches whose files all have half of ``target`` or more are left alone, and so is a day with
    fewer than two others. Files of a partition value are packed by size, each bin is read, shuffled and written by
    one task, and a value with a third of all rows is many bins.

    New files are complete, and a numbered file says which folders they replace, before any folder is: a lost run is
    finished by the next, and changes nothing if it has written no such file. While folders change places, a reader may
    miss a day's rows or, through the catalog, look for files that are gone: run this when none is at work. ``table``
    names the catalog table over ``location``, whose partitions are kept the same as the folders. ``schema`` has the
    columns of the files; partition columns are read as the text they are. An empty table, or none, has no files to
    count.
    """
    if table_format.lower() in VERSIONED:
        raise ValueError(f"{table_format} compacts its own files")
    location = full_path(spark, location)
    _finish(spark, location, table, ingest_date, partitions)
    nothing = {"files_before": 0, "files_after": 0}
    days = partition_directories(spark, location) if ingest_date else [""]
    batches = {d: [int(b.partition("=")[2]) for b in partition_directories(spark, f"{location}/{d}")] for d in days}
    newest = max((n for numbers in batches.values() for n in numbers), default=-1)
    last = newest - 1 if through is None else min(through, newest - 1)
    closed = {d: sorted(n for n in numbers if n <= last) for d, numbers in batches.items()}
    folder = lambda day, n: f"{day}/{BATCH}={n}".lstrip("/")
    looked_at = [folder(d, n) for d, numbers in closed.items() if len(numbers) > 1 for n in numbers]
    if not looked_at:
        return nothing

    sizes: dict[str, dict[int, list[tuple[str, int]]]] = defaultdict(lambda: defaultdict(list))
    for path, size in _files(spark, location, looked_at, f"*.{table_format}"):
        entry, _, file = path.rpartition("/")
        day, _, rest = entry.rpartition(f"{BATCH}=")
        sizes[day.rstrip("/")][int(rest.split("/")[0])].append((path, size))
    groups, plan, into = [], [], []
    for day, by_batch in sizes.items():
        merged = sorted(n for n, files in by_batch.items() if min(s for _, s in files) < target // 2)
        if len(merged) < 2:
            continue
        groups.append({"day": day, "into": merged[-1], "from": merged})
        by_value: dict[str, list[tuple[str, int]]] = defaultdict(list)
        for n in merged:
            for path, size in by_batch[n]:
                by_value[path.rpartition("/")[0].partition(f"{BATCH}={n}")[2]].append((path, size))
        for value, files in by_value.items():
            chosen = fill_bins([s for _, s in files], target)
            for (path, _), b in zip(files, chosen):
                entry, _, file = path.rpartition("/")
                plan.append((*_values(entry), file, str(merged[-1]), len(into) + b))
            into += [f"{folder(day.rstrip('/'), merged[-1])}{value}"] * (max(chosen) + 1)
    if not plan:
        return nothing

    levels = [*([ingest_date] if ingest_date else []), BATCH, *partitions]
    kept = [f for f in schema.fields if f.name not in levels]
    whole = StructType([*kept, *(StructField(n, StringType()) for n in levels)])
    paths = [f"{location}/{folder(g['day'], n)}" for g in groups for n in g["from"]]
    rows = spark.read.format(table_format).schema(whole).option("basePath", location).load(paths)
    number, _ = last_commit(spark, f"{location}/{COMMITS}")
    staged = f"_compacted-{number + 1}"  # a run that is lost before it is committed is written over by the next
    writer = _rewritten(rows, levels, plan, len(into)).write.format(table_format).mode("overwrite")
    writer.save(f"{location}/{staged}")
    _into_folders(spark, f"{location}/{staged}", into, f".{table_format}")
    add_commit(spark, f"{location}/{COMMITS}", number + 1, {"staged": staged, "groups": groups})
    _finish(spark, location, table, ingest_date, partitions)
    return {"files_before": len(plan), "files_after": len(into)}


def _finish(spark: SparkSession, location: str, table: str | None, ingest_date: str | None, partitions: Sequence[str]) -> None:
    """Put what the last run has written into its places, as far as that is not done; any number of times."""
    number, content = last_commit(spark, f"{location}/{COMMITS}")
    if not content.get("groups"):
        return
    for group in content["groups"]:
        day = f"{location}/{group['day']}".rstrip("/")
        new = f"{location}/{content['staged']}/{group['day']}".rstrip("/") + f"/{BATCH}={group['into']}"
        if file_exists(spark, new):
            for n in group["from"]:
                remove_folder(spark, f"{day}/{BATCH}={n}")
            move_folder(spark, new, f"{day}/{BATCH}={group['into']}")
    if table:
        gone = {f"{g['day']}/{BATCH}={n}".lstrip("/") for g in content["groups"] for n in g["from"]}
        there = {f"{g['day']}/{BATCH}={g['into']}".lstrip("/") for g in content["groups"]}
        replace_partitions(spark, table, location, gone, there, len(partitions))
    remove_folder(spark, f"{location}/{content['staged']}")
    add_commit(spark, f"{location}/{COMMITS}", number + 1, {"groups": []})
