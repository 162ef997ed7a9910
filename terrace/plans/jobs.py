"""The layers as jobs: raw files to a raw table, to a clean table, to features."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import yaml
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from terrace.contract import load_contract, load_schema, schema_from_dict, validate_contract
from terrace.operators.batch_statistics import write_statistics
from terrace.operators.features import Strategy, build_features, join_features, strategy
from terrace.plans.cleaning import BUILT_IN, clean
from terrace.plans.incremental import clean_new_batches
from terrace.scratch import scratch_removed
from terrace.sources import overwrite_table, read_new_files, read_table
from terrace.sources.files import passed_over
from terrace.sources.tables import VERSIONED, register_batches
from terrace.streaming import BATCH, append_new
from terrace.streaming.compaction import TARGET, compact_batches

# Fixed value: the steps a clean table gets when the job names none.
SILVER_STEPS = ("remove_duplicates", "convert_types", "null_handling")
INGEST_DATE = "ingest_date"


def _schema(schema: StructType | Mapping[str, Any] | str) -> StructType:
    if isinstance(schema, StructType):
        return schema
    return load_schema(schema) if isinstance(schema, str) else schema_from_dict(schema)


@dataclass
class Bronze:
    """New files of one kind into one raw table. ``rows_read`` is there after a run.

    With an ``archive``, or a ``max_file_age`` among the reader's options, ``passed_over`` counts the files that were left
    behind unread for good (``terrace.sources.files.passed_over`` names them).

    With ``quarantine``, records that do not fit the schema are rows of another table, named ``.._rejected``, with their
    ``file``, ``text`` and ``reason``, instead of rows of nulls in this one.

    ``statistics`` is a cleaning contract: what its means and medians need is kept, batch by batch, in the directory
    ``statistics`` beside the data, where the step ``null_handling`` takes it from with its option of that name.
    """

    table: str
    source: str
    base_path: str
    schema: StructType | Mapping[str, Any] | str
    file_type: str = "csv"
    partitions: Sequence[str] = ()
    table_format: str = "parquet"
    tasks_per_file: int | None = 16
    archive: str | None = None
    quarantine: bool = False
    statistics: Mapping[str, Any] | str | None = None
    reader: Mapping[str, Any] = field(default_factory=dict)
    rows_read: int | None = field(default=None, init=False)
    passed_over: int | None = field(default=None, init=False)


@dataclass
class Silver:
    """One raw table, cleaned by a contract, into another.

    After a run, ``lost`` tells, by step and column, how many values could not be read and became null.

    With ``buckets``, a run cleans the raw table's new batches only, and rewrites those of so many buckets by key that
    they fall into (``clean_new_batches``); ``rewritten`` tells which.
    """

    table: str
    source: str
    location: str
    contract: Mapping[str, Any] | str
    steps: Sequence[str] = SILVER_STEPS
    schema: StructType | Mapping[str, Any] | str | None = None
    options: Mapping[str, Mapping[str, Any]] | None = None
    partitions: Sequence[str] = ()
    table_format: str = "parquet"
    buckets: int | None = None
    lost: dict[str, dict[str, int]] | None = field(default=None, init=False)
    rewritten: list[int] | None = field(default=None, init=False)


@dataclass
class Gold:
    """Features of one kind of entity, from one or more clean tables."""

    table: str
    location: str
    keys: Sequence[str]
    sources: Mapping[str, Sequence[Mapping[str, Any] | Strategy]]
    partitions: Sequence[str] = ()
    table_format: str = "parquet"


def _layout(job: Bronze, schema: StructType) -> tuple[StructType, list[str]]:
    """A raw table's columns, and those of them that are partition levels."""
    batch = [] if job.table_format.lower() in VERSIONED else [BATCH]
    levels = [INGEST_DATE, *batch, *job.partitions]
    fields = {f.name: f for f in [*schema.fields, *(StructField(n, StringType()) for n in (INGEST_DATE, *batch))]}
    return StructType([fields[n] for n in fields if n not in levels] + [fields[n] for n in levels]), levels


def compact_bronze(spark: SparkSession, job: Bronze, *, through: int | None = None, target: int = TARGET) -> dict[str, int]:
    """Rewrite the small files of a raw table's closed batches as larger ones, and count both (``compact_batches``).

    Not beside ``run_bronze`` for the same table, nor before a ``Silver`` with buckets has taken the batches that
    ``through`` allows: what it has not taken must keep its number.
    """
    home = f"{job.base_path.rstrip('/')}/{job.table.rpartition('.')[2]}"
    return compact_batches(
        spark, f"{home}/data", _layout(job, _schema(job.schema))[0], partitions=job.partitions, ingest_date=INGEST_DATE,
        table_format=job.table_format, table=job.table, through=through, target=target,
    )


def run_bronze(spark: SparkSession, job: Bronze) -> str:
    """Append the files not seen before, register the table, give back its name.

    Data and checkpoint have one fixed place per table, side by side.
    """
    schema = _schema(job.schema)
    home = f"{job.base_path.rstrip('/')}/{job.table.rpartition('.')[2]}"
    stream = read_new_files(spark, job.file_type, job.source, schema, archive=job.archive, quarantine=job.quarantine, **job.reader)
    told = load_contract(job.statistics) if isinstance(job.statistics, str) else job.statistics

    def keep_statistics(rows: DataFrame, batch: int) -> None:
        write_statistics(rows, batch, f"{home}/statistics", told)

    job.rows_read = append_new(
        stream,
        f"{home}/data",
        f"{home}/_checkpoint",
        partitions=job.partitions,
        table_format=job.table_format,
        ingest_date=INGEST_DATE,
        tasks_per_file=job.tasks_per_file,
        also=keep_statistics if told else None,
        quarantine=f"{home}/rejected" if job.quarantine else None,
    )
    if job.archive or job.reader.get("max_file_age"):
        kept = {n: job.reader[n] for n in ("max_file_age", "recursive") if n in job.reader}
        job.passed_over = passed_over(spark, job.source, f"{home}/_checkpoint", **kept).count()
    ordered, levels = _layout(job, schema)
    batch = levels[1 : len(levels) - len(job.partitions)]
    if job.quarantine:
        told = StructType([StructField(n, StringType()) for n in ("file", "text", "reason", INGEST_DATE, *batch)])
        register_batches(spark, f"{job.table}_rejected", f"{home}/rejected", job.table_format, schema=told, partitions=[INGEST_DATE, *batch])
    data = f"{home}/data"
    return register_batches(spark, job.table, data, job.table_format, schema=ordered, partitions=levels)


def run_silver(spark: SparkSession, job: Silver) -> str:
    """Clean a table into another and register it.

    With ``schema``, the columns of the files, the load date is left out: a row that came twice on
    different days is then a duplicate.
    """
    contract = load_contract(job.contract) if isinstance(job.contract, str) else job.contract
    if job.buckets is not None:
        return _run_silver_by_batch(spark, job, contract)
    raw = read_table(spark, job.source, None if job.schema is None else _schema(job.schema))
    # A step of the user's own may make columns that later steps use.
    columns = raw.columns if set(job.steps) <= BUILT_IN else None
    validate_contract({s: contract.get(s) for s in job.steps}, columns)
    counts: dict[str, Observation] = {}
    with scratch_removed(spark):
        cleaned = clean(raw, job.steps, contract, job.options, counts)
        overwrite_table(cleaned, job.table, job.location, table_format=job.table_format, partitions=job.partitions)
    job.lost = {step: dict(seen.get) for step, seen in counts.items()}
    return job.table


def _run_silver_by_batch(spark: SparkSession, job: Silver, contract: Mapping[str, Any]) -> str:
    if job.partitions or job.table_format.lower() != "parquet" or job.buckets < 1:
        raise ValueError("a table kept by batch is Parquet, partitioned by its buckets only, of which there is one at least")
    schema = None if job.schema is None else _schema(job.schema)
    validate_contract({s: contract.get(s) for s in job.steps}, schema.names if schema else None)
    counts: dict[str, Observation] = {}
    job.rewritten = clean_new_batches(
        spark, job.source, job.table, job.location, job.steps, contract, job.options, schema, job.buckets, counts
    )
    job.lost = {step: dict(seen.get) for step, seen in counts.items()}
    return job.table


def run_gold(spark: SparkSession, job: Gold) -> str:
    """Build the feature table and register it."""
    parts = [
        build_features(read_table(spark, source), job.keys, [strategy(s) for s in specs])
        for source, specs in job.sources.items()
    ]
    features = join_features(parts, job.keys)
    overwrite_table(features, job.table, job.location, table_format=job.table_format, partitions=job.partitions)
    return job.table


LAYERS: dict[str, Callable[[SparkSession, Any], str]] = {"bronze": run_bronze, "silver": run_silver, "gold": run_gold}
KINDS: dict[str, type] = {"bronze": Bronze, "silver": Silver, "gold": Gold}


def load_jobs(path: str) -> dict[str, list[Any]]:
    """Jobs from a YAML file: under each layer's name, a list of what its job class takes."""
    with open(path, encoding="utf-8") as f:
        layers = yaml.safe_load(f) or {}
    _known(layers)
    return {layer: [KINDS[layer](**job) for job in jobs or ()] for layer, jobs in layers.items()}


def _known(layers: Iterable[str]) -> None:
    unknown = [layer for layer in layers if layer not in LAYERS]
    if unknown:
        raise ValueError("unknown layer: " + ", ".join(unknown))


def run_layers(
    spark: SparkSession, jobs: Mapping[str, Sequence[Any]], layers: Sequence[str] = tuple(LAYERS)
) -> list[str]:
    """Run the jobs of each layer in turn and give back the tables written; the first error ends it."""
    _known(layers)
    return [LAYERS[layer](spark, job) for layer in layers for job in jobs.get(layer, ())]
