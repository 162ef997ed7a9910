"""Directories of files as streams that deliver each new file once."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType

from terrace.functions import column, delimiter_pattern, split_by_position


# Old enough for any file; what Spark takes for the age of files to pass over.
AGE = "36500d"
# The column that tells where a record is from and why it could not be read; null for the others.
REJECTED = "rejected"
# What Spark's readers put the text of such a record into.
_RAW = "rejected_record"
# The options that mean something for a built-in file type.
USED = {
    "csv": ("delimiter", "header", "multiline"),
    "json": ("multiline",),
    "text": ("delimiter", "delimiter_is_regex"),
}


@dataclass(frozen=True)
class FileOptions:
    """How the files are written."""

    delimiter: str = ","
    delimiter_is_regex: bool = False
    header: bool = True
    multiline: bool = False
    extra: Mapping[str, Any] = field(default_factory=dict)
    quarantine: bool = False

    @classmethod
    def given(
        cls, file_type: str, options: Mapping[str, Any], extra: Mapping[str, Any], quarantine: bool = False
    ) -> FileOptions:
        """The options that are not None, which must be among those the file type uses."""
        told = {k: v for k, v in options.items() if v is not None}
        unused = sorted(set(told) - set(USED.get(file_type, told)))
        if unused:
            raise ValueError(f"{file_type} files have no use for: {', '.join(unused)}")
        return cls(**told, extra=dict(extra), quarantine=quarantine)

    def __post_init__(self) -> None:
        if not self.delimiter:
            raise ValueError("the delimiter must not be empty")
        for flag in ("delimiter_is_regex", "header", "multiline"):
            if not isinstance(getattr(self, flag), bool):
                raise ValueError(f"{flag} must be True or False, not {getattr(self, flag)!r}")


Source = Callable[[DataStreamReader, str, StructType, FileOptions], DataFrame]


def _csv(reader: DataStreamReader, path: str, schema: StructType, options: FileOptions) -> DataFrame:
    """Columns bind by position; short rows end in nulls, long ones are cut, an empty field is null.

    With ``multiline``, quoted fields may hold line breaks, and a file is one task's.
    """
    told = dict(sep=options.delimiter, header=options.header, nullValue="", multiLine=options.multiline)
    if options.quarantine:
        rows = _with_raw(reader, schema).csv(path, **told)
        return _rejecting(rows, column(_RAW), F.lit(f"not {len(schema)} fields")).drop(_RAW)
    return reader.schema(schema).csv(path, **told)


def _json(reader: DataStreamReader, path: str, schema: StructType, options: FileOptions) -> DataFrame:
    """Columns bind by name; a missing key is null, a malformed record all null, a nested value its text."""
    if options.quarantine:
        rows = _with_raw(reader, schema).json(path, multiLine=options.multiline)
        return _rejecting(rows, column(_RAW), F.lit("not a JSON object")).drop(_RAW)
    return reader.schema(schema).json(path, multiLine=options.multiline)


def _text(reader: DataStreamReader, path: str, schema: StructType, options: FileOptions) -> DataFrame:
    """Lines split by position. A header line is data and an empty piece stays empty."""
    lines = reader.text(path)
    if options.quarantine:
        pieces, wanted = F.size(F.split("value", delimiter_pattern(options.delimiter, options.delimiter_is_regex))), len(schema)
        reason = F.concat(pieces.cast("string"), F.lit(f" pieces, not {wanted}"))
        told = _rejecting(lines, F.when(pieces != wanted, F.col("value")), reason)
        return split_by_position(told, schema.names, options.delimiter, options.delimiter_is_regex, keep=[REJECTED])
    return split_by_position(lines, schema.names, options.delimiter, options.delimiter_is_regex)


def _with_raw(reader: DataStreamReader, schema: StructType) -> DataStreamReader:
    return reader.schema(StructType([*schema, StructField(_RAW, StringType())])).option("columnNameOfCorruptRecord", _RAW)


def _rejecting(rows: DataFrame, text: Column, reason: Column) -> DataFrame:
    """The rows with ``rejected``: file, text and reason of a record whose ``text`` is there, else null."""
    told = F.struct(F.col("_metadata.file_path").alias("file"), text.alias("text"), reason.alias("reason"))
    return rows.withColumn(REJECTED, F.when(text.isNotNull(), told))


SOURCES: dict[str, Source] = {"csv": _csv, "json": _json, "text": _text}


def register_source(file_type: str, source: Source) -> None:
    """Add a file type: a function from a stream reader, path, schema and options to a streaming table."""
    SOURCES[file_type] = source


def read_new_files(
    spark: SparkSession,
    file_type: str,
    path: str,
    schema: StructType,
    *,
    delimiter: str | None = None,
    delimiter_is_regex: bool | None = None,
    header: bool | None = None,
    multiline: bool | None = None,
    recursive: bool = False,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    max_file_age: str | None = None,
    archive: str | None = None,
    quarantine: bool = False,
    extra: Mapping[str, Any] | None = None,
) -> DataFrame:
    """A stream of the files under ``path``, of the declared schema; nothing is inferred.

    An option that the file type has no use for is an error.

    Which files are new is the business of the checkpoint the stream is written with. Spark passes
    over files older than ``max_file_age`` before the newest one. Unless given, it is so long that no late file
    is lost, at the price that the driver remembers the name of every file; ``passed_over`` tells what a shorter
    one leaves behind. With ``archive``, a directory outside ``path``, files are moved there once read, so that the
    listing does not grow.
    ``max_files_per_trigger`` and ``max_bytes_per_trigger`` cut a large backlog into
    batches that are committed one by one.

    With ``quarantine``, records that do not fit the schema are told by one more column, ``rejected``, with their file,
    text and the reason: CSV lines and text lines with another number of fields, and JSON that does not parse or is no
    object. ``append_new`` keeps them apart. Without it their fields are null or cut, and their text is lost.
    """
    if file_type not in SOURCES:
        raise ValueError(f"unknown file type '{file_type}': use one of {', '.join(sorted(SOURCES))}")
    given = dict(delimiter=delimiter, delimiter_is_regex=delimiter_is_regex, header=header, multiline=multiline)
    if quarantine and file_type not in USED:
        raise ValueError(f"nothing tells which records of {file_type} files do not fit")
    if quarantine and {REJECTED, _RAW} & {n.lower() for n in schema.names}:
        raise ValueError(f"the files have a column '{REJECTED}' or '{_RAW}' of their own")
    options = FileOptions.given(file_type, given, extra or {}, quarantine)
    settings = {
        "maxFileAge": max_file_age or AGE,
        "cleanSource": "archive" if archive else None,
        "sourceArchiveDir": archive,
        "recursiveFileLookup": str(recursive).lower() if recursive else None,
        "maxFilesPerTrigger": max_files_per_trigger,
        "maxBytesPerTrigger": max_bytes_per_trigger,
        **options.extra,
    }
    reader = spark.readStream.options(**{k: v for k, v in settings.items() if v is not None})
    return SOURCES[file_type](reader, path, schema, options)


def passed_over(
    spark: SparkSession, path: str, checkpoint: str, *, max_file_age: str | None = None, recursive: bool = False
) -> DataFrame:
    """``file`` and ``modified`` of the files under ``path`` that no run with this checkpoint has read or will read.

    These are files that were changed, or put there again under the same name, after they were read, and files older
    than ``max_file_age`` before the newest one read. Files that wait for the next run are not among them. Listing and
    log are compared as tables.
    """
    given = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    # file:///a and file:/a are one file.
    plain = lambda c: F.regexp_replace(c, r"^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/").alias("file")
    here = given.select(
        plain("_metadata.file_path"), F.unix_millis("_metadata.file_modification_time").alias("at")
    )
    log = spark.read.text(f"{checkpoint.rstrip('/')}/sources/0").where("value LIKE '{%'")
    read = log.select(F.from_json("value", "path string, timestamp long").alias("f"))
    read = read.groupBy(plain("f.path")).agg(F.max("f.timestamp").alias("read_at"))
    age = spark._jvm.org.apache.spark.network.util.JavaUtils.timeStringAsSec(max_file_age or AGE) * 1000
    oldest = read.agg((F.max("read_at") - F.lit(age)).alias("oldest")).select("oldest").scalar()
    left = here.join(read, "file", "left").withColumn("oldest", oldest)
    lost = (F.col("read_at") != F.col("at")) | (F.col("read_at").isNull() & (F.col("at") < F.col("oldest")))
    return left.where(lost).select("file", F.timestamp_millis("at").alias("modified"))
