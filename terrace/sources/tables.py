"""Catalog tables over files at a known place."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from terrace.functions import column, quote, quote_table, sql_text

# Formats that keep their own versions and replace a table in place.
VERSIONED = ("delta",)


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says about a table: ``Type``, ``Provider``, ``Location`` and so on."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(table)}").collect()
    names = [r["col_name"] for r in rows]
    start = names.index("# Detailed Table Information")
    return {r["col_name"]: r["data_type"] for r in rows[start + 1 :]}


def register(
    spark: SparkSession,
    table: str,
    location: str,
    table_format: str = "parquet",
    *,
    schema: StructType | None = None,
    partitions: Sequence[str] = (),
) -> str:
    """Make the files at ``location`` a table, creating its database first; give back its name.

    A table already there must be at the same place: ``IF NOT EXISTS`` alone would quietly leave
    the old one. The file list that the session may have cached is refreshed, and partitions are
    looked up.
    """
    name = quote_table(table)
    database, _, _ = table.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_table(database)}")
    # Where there are files, a new table gets the types that its directory names look like, not the
    # declared ones. So it is declared over nothing and pointed at its files then.
    nothing = f"{location.rstrip('/')}/_declared"
    declare = schema is not None and table_format.lower() not in VERSIONED
    if not spark.catalog.tableExists(name):
        columns = f"({schema.toDDL()})" if declare else ""
        by = f"PARTITIONED BY ({', '.join(map(quote, partitions))})" if declare and partitions else ""
        place = sql_text(nothing if declare else location)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {columns} USING {quote(table_format)} {by} LOCATION {place}")
    present = _details(spark, table).get("Location", location)
    if _same_place(present, nothing):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {sql_text(location)}")
    elif not _same_place(present, location):
        raise ValueError(f"table {table} is at {present}, not at {location}")
    if partitions and declare and _exists(spark, location):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.sql(f"REFRESH TABLE {name}")
    return table


#: The table property that names the last batch whose partitions the catalog has.
LAST_BATCH = "terrace.last_batch"
#: Partitions named in one statement.
AT_ONCE = 200


def _listed(spark: SparkSession, location: str) -> list[str]:
    """The names of the partition directories right below a place; every listing of one goes through here."""
    place = spark._jvm.org.apache.hadoop.fs.Path(location)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return sorted(f.getPath().getName() for f in found if f.isDirectory() and "=" in f.getPath().getName())


def _below(spark: SparkSession, location: str, entry: str, depth: int) -> list[str]:
    if not depth:
        return [entry]
    return [e for n in _listed(spark, f"{location}/{entry}") for e in _below(spark, location, f"{entry}/{n}", depth - 1)]


def partition_directories(spark: SparkSession, location: str) -> list[str]:
    """The names of the partition directories right below a place; none where there is no such place."""
    return _listed(spark, location) if _exists(spark, location) else []


def replace_partitions(
    spark: SparkSession, table: str, location: str, gone: set[str], there: set[str], depth: int
) -> None:
    """Let the catalog have the partitions of the directories ``there``, ``depth`` levels below, instead of those of ``gone``.

    Statements go with these directories, whatever else the table has. A table that is not there is left alone.
    """
    name, place = quote_table(table), location.rstrip("/")
    if not spark.catalog.tableExists(name):
        return
    new = {e for entry in there for e in _below(spark, place, entry, depth)}
    prefix = lambda e: "/".join(e.split("/")[: len(e.split("/")) - depth])
    days = {d for d, _, _ in (e.rpartition("/") for e in gone)}
    known = [
        r[0] for d in sorted(days) for r in spark.sql(f"SHOW PARTITIONS {name} {_partition(d) if d else ''}").collect()
    ]
    old = sorted(e for e in known if prefix(e) in gone and e not in new)
    added = sorted(new - set(known))
    for i in range(0, len(added), AT_ONCE):
        parts = " ".join(f"{_partition(e)} LOCATION {sql_text(f'{place}/{e}')}" for e in added[i : i + AT_ONCE])
        _run(spark, f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    for i in range(0, len(old), AT_ONCE):
        _run(spark, f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(_partition, old[i : i + AT_ONCE]))}")
    _run(spark, f"REFRESH TABLE {name}")


def register_batches(
    spark: SparkSession,
    table: str,
    location: str,
    table_format: str = "parquet",
    *,
    schema: StructType,
    partitions: Sequence[str],
) -> str:
    """``register`` for a table of ``append_new``, whose first two partition levels are load date and batch.

    All partitions are looked up when the table is made. From then on a run adds those of the batches that came after
    the last one added, which a property of the table names: what it lists and states goes with the new batches, however
    many the table has. A run lost before it added its batches leaves them to the next.
    """
    name, place = quote_table(table), location.rstrip("/")
    if table_format.lower() in VERSIONED or len(partitions) < 2:
        return register(spark, table, location, table_format, schema=schema, partitions=partitions)
    known = spark.catalog.tableExists(name)
    told = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()} if known else {}
    mark = told.get(LAST_BATCH, "")
    days = _listed(spark, place) if _exists(spark, place) else []
    date, _, last = mark.partition("/")
    number = lambda entry: int(entry.rpartition("=")[2])
    batches = [f"{day}/{b}" for day in days if not mark or day >= date for b in _listed(spark, f"{place}/{day}")]
    new = [b for b in batches if not mark or number(b) > int(last)]
    if not mark:
        register(spark, table, location, table_format, schema=schema, partitions=partitions)
    elif not _same_place(found := _details(spark, table).get("Location", location), location):
        raise ValueError(f"table {table} is at {found}, not at {location}")
    else:
        entries = [e for b in new for e in _below(spark, place, b, len(partitions) - 2)]
        for i in range(0, len(entries), AT_ONCE):
            added = " ".join(f"{_partition(e)} LOCATION {sql_text(f'{place}/{e}')}" for e in entries[i : i + AT_ONCE])
            _run(spark, f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    if new:
        newest = max(new, key=number)
        _run(spark, f"ALTER TABLE {name} SET TBLPROPERTIES ({sql_text(LAST_BATCH)} = {sql_text(f'{newest.split("/")[0]}/{number(newest)}')})")
        _run(spark, f"REFRESH TABLE {name}")
    return table


def _exists(spark: SparkSession, location: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(location)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _same_place(a: str, b: str) -> bool:
    """``file:/a``, ``file:///a/`` and ``/a`` are one place; a path without a scheme is on the default one."""
    (scheme_a, host_a, path_a), (scheme_b, host_b, path_b) = _parts(a), _parts(b)
    same_store = not scheme_a or not scheme_b or (scheme_a, host_a) == (scheme_b, host_b)
    return same_store and path_a == path_b


def _parts(location: str) -> tuple[str, str, str]:
    scheme, host, path = re.fullmatch(r"(?:([A-Za-z][\w+.-]*):)?(?://([^/]*))?(.*)", location, re.DOTALL).groups()
    return scheme or "", host or "", path.rstrip("/")


def read_table(spark: SparkSession, table: str, schema: StructType | None = None) -> DataFrame:
    """A table as its files are now or, given ``schema``, the columns named there."""
    name = quote_table(table)
    spark.sql(f"REFRESH TABLE {name}")
    whole = spark.table(name)
    return whole if schema is None else whole.select(*[column(n) for n in schema.names])


def _run(spark: SparkSession, statement: str) -> DataFrame:
    """Every statement that changes the catalog when a table is replaced."""
    return spark.sql(statement)


def _same_layout(spark: SparkSession, table: str, table_format: str, schema: StructType, partitions: Sequence[str]) -> bool:
    """Whether the table could hold such rows as it is: format, columns and partitions."""
    name = quote_table(table)
    if [c.name for c in spark.catalog.listColumns(name) if c.isPartition] != list(partitions):
        return False
    columns = [(f.name, f.dataType) for f in spark.table(name).schema]
    provider = _details(spark, table).get("Provider", "")
    return provider.lower() == table_format.lower() and columns == [(f.name, f.dataType) for f in schema]


def _partitions(spark: SparkSession, table: str) -> set[str]:
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {quote_table(table)}").collect()}


def _partition(entry: str) -> str:
    """``a=1/b=x`` as a partition in SQL."""
    values = []
    for level in entry.split("/"):
        name, _, value = level.partition("=")
        text = "NULL" if value == "__HIVE_DEFAULT_PARTITION__" else sql_text(unquote(value))
        values.append(f"{quote(unquote(name))} = {text}")
    return f"PARTITION ({', '.join(values)})"


def _point_at(spark: SparkSession, table: str, staged: str, version: str, partitions: Sequence[str]) -> None:
    """Point a table, and one after another its partitions, at new files; it can be read all the while."""
    name = quote_table(table)
    new, old = (_partitions(spark, t) if partitions else set() for t in (staged, table))
    _run(spark, f"ALTER TABLE {name} SET LOCATION {sql_text(version)}")
    for entry in sorted(new):
        place = sql_text(f"{version}/{entry}")
        if entry in old:
            _run(spark, f"ALTER TABLE {name} {_partition(entry)} SET LOCATION {place}")
        else:
            _run(spark, f"ALTER TABLE {name} ADD IF NOT EXISTS {_partition(entry)} LOCATION {place}")
    for entry in sorted(old - new):
        _run(spark, f"ALTER TABLE {name} DROP IF EXISTS {_partition(entry)}")


def _describe_alike(spark: SparkSession, table: str, staged: str) -> None:
    """Give the new table the old one's properties and comments, as far as it has the columns."""
    name, other = quote_table(table), quote_table(staged)
    for key, value in spark.sql(f"SHOW TBLPROPERTIES {name}").collect():
        if not key.startswith(("spark.sql.", "transient_", "numFiles", "totalSize")):
            _run(spark, f"ALTER TABLE {other} SET TBLPROPERTIES ({sql_text(key)} = {sql_text(value)})")
    if comment := _details(spark, table).get("Comment"):
        _run(spark, f"COMMENT ON TABLE {other} IS {sql_text(comment)}")
    there = {c.name for c in spark.catalog.listColumns(other) if not c.isPartition}
    for c in spark.catalog.listColumns(name):
        if c.description and c.name in there:
            _run(spark, f"ALTER TABLE {other} ALTER COLUMN {quote(c.name)} COMMENT {sql_text(c.description)}")


def _take_name(spark: SparkSession, table: str, staged: str) -> None:
    """Let the staged table have the name; the old one has it back if that fails, and goes last."""
    name, aside = quote_table(table), f"{staged}_old"
    within = lambda t: ".".join(map(quote, t.split(".")[-2:]))
    _run(spark, f"ALTER TABLE {name} RENAME TO {within(aside)}")
    try:
        _run(spark, f"ALTER TABLE {quote_table(staged)} RENAME TO {within(table)}")
    except Exception:
        spark.sql(f"ALTER TABLE {quote_table(aside)} RENAME TO {within(table)}")
        raise
    _run(spark, f"DROP TABLE {quote_table(aside)}")


def overwrite_table(
    df: DataFrame, table: str, location: str, *, table_format: str = "parquet", partitions: Sequence[str] = ()
) -> str:
    """Replace a table, schema included, and give back where its files now are.

    Plain files go to a new directory under ``location``, and are a table of another name when all of them are
    written. Where format, columns and partitions are the same, the table is then pointed at them, without a
    moment in which it cannot be read; a partitioned table partition by partition, so that a reader may meet
    some old ones beside new ones. Otherwise the new table takes the name, with the old one's properties and
    comments. So a table can be replaced from itself, a failed run leaves the old one untouched, and readers at
    work keep their files; old directories are the caller's to remove. Formats with versions of their own are
    overwritten in place.
    """
    spark = df.sparkSession
    if partitions:
        # Gathers each partition's rows into few files and splits the partitions that are too big.
        df = df.hint("rebalance", *partitions)
    writer = df.write.format(table_format).partitionBy(*partitions)
    if table_format.lower() in VERSIONED:
        writer.mode("overwrite").option("overwriteSchema", "true").save(location)
        register(spark, table, location, table_format)
        return location

    known = spark.catalog.tableExists(quote_table(table))
    if known and _details(spark, table).get("Type", "").upper() == "MANAGED":
        raise ValueError(f"{table} owns its files: dropping it would delete them")
    stamp = f"{datetime.now(timezone.utc).strftime('%Y%m%dT%H%M%S%f')}-{uuid.uuid4().hex[:8]}"
    version = f"{location.rstrip('/')}/version-{stamp}"
    writer.mode("errorifexists").save(version)
    ordered = [n for n in df.columns if n not in partitions] + list(partitions)
    schema = StructType([df.schema[n] for n in ordered])
    if not known:
        register(spark, table, version, table_format, schema=schema, partitions=partitions)
        return version
    staged = f"{table}__{stamp.replace('-', '_')}"
    register(spark, staged, version, table_format, schema=schema, partitions=partitions)
    try:
        if _same_layout(spark, table, table_format, schema, partitions):
            _point_at(spark, table, staged, version, partitions)
        else:
            _describe_alike(spark, table, staged)
            _take_name(spark, table, staged)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {quote_table(staged)}")
    spark.sql(f"REFRESH TABLE {quote_table(table)}")
    return version
