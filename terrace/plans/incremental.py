"""A clean table kept up to date batch by batch.

Rows live in buckets by a hash of their key. Which batches of the raw table are in, and where each bucket's files are, is
told by a numbered file beside the table (``_commits``). A run cleans the batches that are not in yet, and rewrites the
buckets that their keys fall into, no others. A clean table may hold other values than those its duplicates were told
by, so the rows as they were right after deduplication are kept too (``kept``), in the same buckets.

A run that is lost leaves files that no commit names. One lost between its commit and the catalog is made good by the
next, which points the table at the last commit again before it looks for batches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from terrace.contract import as_list, fill_rule, section
from terrace.functions import column, quote, quote_table, sql_text
from terrace.functions.columns import is_fractional
from terrace.plans.cleaning import clean
from terrace.sources import read_table, register
from terrace.sources.commits import add_commit, last_commit, make_folder, remove_folder
from terrace.streaming import BATCH

# The partition level of a table kept by batch.
BUCKET = "silver_bucket"
#: Steps that look at one row at a time.
ROW_BY_ROW = ("remove_nulls", "convert_types", "null_handling", "normalize_text", "normalize_timestamp")
#: Partitions named in one statement.
AT_ONCE = 500


def split_steps(steps: Sequence[str], contract: Mapping[str, Any]) -> tuple[list[str], list[str]]:
    """The steps before and after the deduplication, all of which must look at one row at a time."""
    if list(steps).count("remove_duplicates") != 1:
        raise ValueError("a table kept by batch needs the step remove_duplicates, once: its columns tell which rows meet")
    at = list(steps).index("remove_duplicates")
    others = [*steps[:at], *steps[at + 1 :]]
    if unfit := [s for s in others if s not in ROW_BY_ROW]:
        raise ValueError("a table kept by batch has only steps that look at one row at a time, not " + ", ".join(unfit))
    fills = section(contract, "null_handling") or {} if "null_handling" in others else {}
    if learnt := [n for n, rule in fills.items() if fill_rule(rule)[0] != "constant"]:
        raise ValueError(f"a mean or median changes with every batch: learn the fill of {', '.join(learnt)} apart")
    return list(steps[:at]), list(steps[at + 1 :])


def _hashed(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row's key; values that deduplication takes for equal fall into one."""
    types = {n: df.schema[n].dataType for n in keys}
    same = [F.nanvl(column(n) + F.lit(0.0), F.lit(float("nan"))) if is_fractional(types[n]) else column(n) for n in keys]
    return F.pmod(F.xxhash64(*same), F.lit(buckets)).cast("int")


def _batches(spark: SparkSession, table: str) -> list[int]:
    """The batches a raw table has, from the catalog: no file is read."""
    entries = spark.sql(f"SHOW PARTITIONS {quote_table(table)}")
    batch = F.regexp_extract("partition", f"(?:^|/){BATCH}=(\\d+)(?:/|$)", 1)
    return sorted(int(r[0]) for r in entries.select(batch).distinct().collect() if r[0])


def _ranges(numbers: Sequence[int]) -> list[list[int]]:
    """Sorted numbers as first and last of each stretch without a gap."""
    out: list[list[int]] = []
    for n in numbers:
        if out and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return out


def _point(spark: SparkSession, table: str, where: Mapping[str, str], moved: Sequence[str]) -> None:
    """Have the table's buckets at these places: new ones by one statement for many, moved ones one by one."""
    name, entries = quote_table(table), sorted(where.items(), key=lambda e: int(e[0]))
    for i in range(0, len(entries), AT_ONCE):
        places = " ".join(f"PARTITION ({quote(BUCKET)} = {b}) LOCATION {sql_text(p)}" for b, p in entries[i : i + AT_ONCE])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
    for bucket in moved:
        spark.sql(f"ALTER TABLE {name} PARTITION ({quote(BUCKET)} = {bucket}) SET LOCATION {sql_text(where[bucket])}")
    spark.sql(f"REFRESH TABLE {name}")


def clean_new_batches(
    spark: SparkSession,
    source: str,
    table: str,
    location: str,
    steps: Sequence[str],
    contract: Mapping[str, Any],
    options: Mapping[str, Mapping[str, Any]] | None = None,
    schema: StructType | None = None,
    buckets: int = 64,
    lost: dict[str, Observation] | None = None,
) -> list[int]:
    """Clean the batches of ``source`` that ``table`` does not have yet; give back the buckets that were rewritten.

    The table then holds what cleaning all batches together gives, where the contract's ``order_by`` says which row of a
    key stays; without it, the row that came in an earlier batch does. Null keys are equal, as ever. Without new batches,
    or when a run is repeated, nothing is written. The number of buckets, the steps, their contract and the columns are
    settled by the first run: others are an error, as rows already cleaned would have to be cleaned anew.

    ``source`` is a table of ``run_bronze``, with a partition level ``ingest_batch``. A bucket is rewritten whole, so a
    run costs the buckets its keys fall into: take more buckets for a larger table. ``lost`` counts values lost in the
    rows of the buckets written.
    """
    first, then = split_steps(steps, contract)
    told = json.loads(json.dumps([list(steps), {s: section(contract, s) for s in steps}, options or {}, buckets, schema and schema.jsonValue()], default=str))
    commits, home = f"{location.rstrip('/')}/_commits", location.rstrip("/")
    number, state = last_commit(spark, commits)
    if state and state["told"] != told:
        raise ValueError(f"{table} was built by another contract: rebuild it at another location")
    exists = spark.catalog.tableExists(quote_table(table))
    if state:
        columns = StructType.fromJson(state["columns"])
        register(spark, table, f"{home}/_table", schema=columns, partitions=[BUCKET])
        _point(spark, table, state["clean"], state["moved"] if exists else [])
    have = {n for a, b in state.get("batches", []) for n in range(a, b + 1)}
    new = [n for n in _batches(spark, source) if n not in have]
    if not new:
        return []

    whole = read_table(spark, source)
    names = [n for n in whole.columns if n != BATCH] if schema is None else schema.names
    rows = whole.where(column(BATCH).isin([str(n) for n in new])).select(*[column(n) for n in names])
    rows = clean(rows, first, contract, options)
    keys = as_list((section(contract, "remove_duplicates") or {}).get("subset_cols")) or rows.columns
    bucket = _hashed(rows, keys, buckets)
    touched = sorted(r[0] for r in rows.select(bucket.alias("b")).distinct().collect())

    run = f"{home}/run-{number + 1}-{uuid.uuid4().hex[:8]}"
    kept, cleaned = dict(state.get("kept", {})), dict(state.get("clean", {}))
    replaced = {str(b): kept[str(b)] for b in touched if str(b) in kept}
    if replaced:
        # What is there comes first, so that the row of an earlier batch stays where nothing else decides.
        older = spark.read.schema(rows.schema).parquet(*replaced.values())
        rows = _first_of(older, rows, keys, contract, options)
    else:
        rows = clean(rows, ["remove_duplicates"], contract, options)
    rows.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{run}/kept")

    held = spark.read.schema(StructType([*rows.schema, StructField(BUCKET, IntegerType())])).parquet(f"{run}/kept")
    done = clean(held.drop(BUCKET).withColumn(BUCKET, _hashed(held, keys, buckets)), then, contract, options, lost)
    done = done.select(*[column(n) for n in done.columns if n != BUCKET], column(BUCKET))
    done.write.partitionBy(BUCKET).parquet(f"{run}/clean")

    moved = [str(b) for b in touched if str(b) in cleaned]
    for b in map(str, touched):
        kept[b], cleaned[b] = f"{run}/kept/{BUCKET}={b}", f"{run}/clean/{BUCKET}={b}"
        make_folder(spark, cleaned[b])  # a bucket may have lost all its rows
    content = {"told": told, "columns": done.schema.jsonValue(), "batches": _ranges(sorted({*have, *new}))}
    add_commit(spark, commits, number + 1, content | {"kept": kept, "clean": cleaned, "moved": moved})
    register(spark, table, f"{home}/_table", schema=done.schema, partitions=[BUCKET])
    _point(spark, table, cleaned, moved if exists else [])
    for old in replaced.values():
        remove_folder(spark, old)
    return touched


def _first_of(
    older: DataFrame, newer: DataFrame, keys: Sequence[str], contract: Mapping[str, Any], options: Mapping[str, Any] | None
) -> DataFrame:
    """One row of each key of both, by the contract's order; else the older one."""
    order = as_list((section(contract, "remove_duplicates") or {}).get("order_by"))
    age = "age_of_the_row"
    both = older.withColumn(age, F.lit(0)).unionByName(newer.withColumn(age, F.lit(1)))
    rules = {"remove_duplicates": {"subset_cols": list(keys), "order_by": [*order, age]}}
    return clean(both, ["remove_duplicates"], rules, options).drop(age)
