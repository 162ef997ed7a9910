"""Append what is new, then stop."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from terrace.functions import column, unused_name
from terrace.sources.files import REJECTED
from terrace.sources.tables import VERSIONED

# The partition level that tells the batches of a stream apart.
BATCH = "ingest_batch"


def _gather(stream: DataFrame, partitions: Sequence[str], tasks: int) -> DataFrame:
    """Bring together what ``tasks`` neighbouring tasks read of each partition value, and no more.

    A value held by a third of all rows is so split by where its rows were read: what one task has
    to write of it is bounded by what these few tasks read, however large the batch. Where that is more than
    adaptive execution's advisory size, it goes to several tasks, as each sorts what it writes.
    """
    group = unused_name(stream, "group")
    grouped = stream.withColumn(group, F.floor(F.spark_partition_id() / tasks))
    keys = [*[column(p) for p in partitions], column(group)]
    adaptive = stream.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return (grouped.hint("rebalance", *keys) if adaptive else grouped.repartition(*keys)).drop(group)


def _run(writer: DataStreamWriter, late: dict[str, int] | None) -> int:
    query: StreamingQuery = writer.start()
    rows: dict[int, int] = {}
    dropped: dict[int, int] = {}
    finished = False
    while not finished:
        # Spark keeps the last progress reports only, hence the look in between.
        finished = query.awaitTermination(1)
        for p in query.recentProgress:
            rows[p["batchId"]] = p["numInputRows"]
            dropped[p["batchId"]] = sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])
    if late is not None:
        late["rows"] = sum(dropped.values())
    return sum(rows.values())


def _batch_date(spark: SparkSession, checkpoint: str, batch: int) -> Column:
    """The date that a batch began on, as its entry in the checkpoint has it, for a replay too.

    It is a constant, so rows need no sort to be written by it, as they would by the stream's ``current_date``.
    """
    entry = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch}").where("value LIKE '{%\"batchTimestampMs\"%'")
    began = entry.select(F.get_json_object("value", "$.batchTimestampMs").cast("long")).first()[0]
    return F.timestamp_millis(F.lit(began)).cast("date").cast("string")


def write_batch(
    rows: DataFrame, batch: int, location: str, levels: Sequence[str], table_format: str, stream: str
) -> None:
    """Put a batch's rows where no other batch's are; writing it again replaces what it wrote before.

    A format with versions of its own is told which batch this is, and takes it once.
    """
    if table_format.lower() in VERSIONED:
        once = {"txnAppId": stream, "txnVersion": str(batch)}
        rows.drop(BATCH).write.format(table_format).mode("append").options(**once).partitionBy(
            *[n for n in levels if n != BATCH]
        ).save(location)
        return
    numbered = rows.withColumn(BATCH, F.lit(str(batch)))
    writer = numbered.write.format(table_format).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*levels).save(location)


def append_new(
    stream: DataFrame,
    location: str,
    checkpoint: str,
    *,
    partitions: Sequence[str] | None = None,
    table_format: str = "parquet",
    ingest_date: str | None = "ingest_date",
    tasks_per_file: int | None = None,
    also: Callable[[DataFrame, int], None] | None = None,
    late: dict[str, int] | None = None,
    quarantine: str | None = None,
) -> int:
    """Append the stream's new rows to the files at ``location`` and give back how many were read.

    Runs until nothing is left to read. The checkpoint makes each row land once: it belongs to this
    location and lies outside it. Every batch has a directory of its own, the partition level
    ``ingest_batch``, which a replay of the batch overwrites: the files there are the table, for any
    reader. ``ingest_date`` names a column, the first partition level, that gets the date of the batch;
    the date is kept with the batch, so a replay does not move rows.

    Without ``tasks_per_file`` nothing is shuffled, and every task that reads writes a file for each
    partition value it meets. With many values that makes many small files; then the rows of a value
    that this many tasks read go to one file, or to several of adaptive execution's advisory size.

    ``also`` is called with each batch's rows and number once they are written, and again when a batch is replayed: what
    it writes must replace what it wrote before. It reads the batch's files again. ``late`` is given, as ``rows``, how
    many rows a step that remembers (``remove_duplicates`` on a stream) has dropped as too late.

    ``quarantine`` is another place, for the records that a stream of ``read_new_files(.., quarantine=True)`` could not
    read: ``file``, ``text`` and ``reason``, by batch as the rows are, and replaced with them when a batch is replayed.
    """
    if checkpoint.rstrip("/") == location.rstrip("/") or checkpoint.startswith(location.rstrip("/") + "/"):
        raise ValueError("the checkpoint must lie outside the table's directory")
    levels = list(partitions or [])
    missing = [p for p in levels if p not in stream.columns]
    if missing:
        raise ValueError("no such partition column: " + ", ".join(missing))
    if tasks_per_file and levels:
        stream = _gather(stream, levels, tasks_per_file)
    if BATCH in stream.columns:
        raise ValueError(f"the files have a column '{BATCH}' of their own")
    levels = [BATCH, *levels]
    if ingest_date:
        if ingest_date in stream.columns:
            raise ValueError(f"the files have a column '{ingest_date}' of their own: name the load date otherwise")
        levels = [ingest_date, *levels]

    if (quarantine is not None) != (REJECTED in stream.columns):
        raise ValueError("a stream that tells what it could not read needs a place for it, and no other does")
    date = [ingest_date] if ingest_date else []

    def write(rows: DataFrame, batch: int) -> None:
        if ingest_date:
            rows = rows.withColumn(ingest_date, _batch_date(rows.sparkSession, checkpoint, batch))
        if quarantine:
            # Files are parsed once for both places.
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
            told = rows.where(column(REJECTED).isNotNull()).select(*map(column, date), f"{REJECTED}.*")
            write_batch(told, batch, quarantine, [*date, BATCH], table_format, f"{checkpoint}-rejected")
            read = rows.where(column(REJECTED).isNull()).drop(REJECTED)
        else:
            read = rows
        write_batch(read, batch, location, levels, table_format, checkpoint)
        if also:
            also(read, batch)
        if quarantine:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _run(writer.trigger(availableNow=True), late)
