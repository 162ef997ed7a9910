"""Files to tables: each query writes whole tables as files, ingests them and reads the result."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace_queries.registry import query, table
from terrace import (
    Bronze,
    append_new,
    build_pipeline,
    compact_bronze,
    overwrite_table,
    read_new_files,
    read_table,
    register,
    register_source,
    run_bronze,
    schema_from_dict,
)
from terrace.scratch import scratch_path


def schema_of(*names: str):
    return schema_from_dict({"columns": [{"name": n} for n in names]})


def new_table(name: str) -> str:
    """A table name nobody else has."""
    return f"default.{name}_{uuid.uuid4().hex}"


def ingest(spark: SparkSession, file_type: str, source: str, names: list[str], **job: Any) -> DataFrame:
    """Run a raw-table job over a directory and read the columns of its files back."""
    schema = schema_of(*names)
    name = run_bronze(
        spark, Bronze(new_table("raw"), source, scratch_path(spark, "raw"), schema, file_type=file_type, **job)
    )
    return read_table(spark, name, schema)


ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDERS_AS_TEXT = """
    CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
    CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS VARCHAR) AS o_totalprice,
    strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
"""


def orders_text(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a file would hold them; every seventh has no priority."""
    return table(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS o_orderkey",
        "CAST(o_custkey AS STRING) AS o_custkey",
        "o_orderstatus",
        "CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS STRING) AS o_totalprice",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS o_orderdate",
        "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority",
    )


_SOME_EMPTY = "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority ELSE '' END AS o_orderpriority"
_SOME_DASHED = "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority ELSE '-' END AS o_orderpriority"
_SOME_NULL = "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority"


@query(f"SELECT {ORDERS_AS_TEXT}, {_SOME_NULL} FROM orders")
def ingest_csv(spark: SparkSession, sf: str) -> DataFrame:
    source = scratch_path(spark, "orders-csv")
    orders_text(spark, sf).write.csv(source, header=True, sep=";")
    return ingest(spark, "csv", source, ORDERS, reader={"delimiter": ";"})


@query(f"SELECT {ORDERS_AS_TEXT}, {_SOME_NULL} FROM orders")
def ingest_csv_no_header(spark: SparkSession, sf: str) -> DataFrame:
    """Fields that hold the delimiter and quotes come back whole."""
    source = scratch_path(spark, "orders-csv")
    noisy = orders_text(spark, sf).withColumn("o_orderstatus", F.concat(F.lit('a,"'), "o_orderstatus"))
    noisy.write.csv(source, escape='"')
    raw = ingest(spark, "csv", source, ORDERS, reader={"header": False, "extra": {"escape": '"'}})
    return raw.withColumn("o_orderstatus", F.expr("""substring(o_orderstatus, length('a,"') + 1)"""))


@query(
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
           CAST(user_id AS VARCHAR) AS user_id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type,
           CAST(value AS VARCHAR) AS value, replace(props, ': ', ':') AS props FROM events
    """
)
def ingest_json(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and objects arrive as their text, absent keys as null."""
    source = scratch_path(spark, "events-json")
    table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        "user_id",
        F.expr("CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type"),
        "value",
        F.from_json("props", "k int").alias("props"),
    ).write.json(source)
    return ingest(spark, "json", source, ["event_id", "ts", "user_id", "event_type", "value", "props"])


_DOCUMENTS_AS_TEXT = """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents
"""
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@query(_DOCUMENTS_AS_TEXT)
def ingest_json_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents, line breaks and all."""
    source = scratch_path(spark, "documents-json")
    table(spark, sf, "documents").write.json(source)
    return ingest(spark, "json", source, DOCUMENTS)


@query(_DOCUMENTS_AS_TEXT)
def ingest_csv_multiline(spark: SparkSession, sf: str) -> DataFrame:
    """The same as CSV, with line breaks inside quotes."""
    source = scratch_path(spark, "documents-csv")
    table(spark, sf, "documents").write.csv(source, header=True, quoteAll=True, escape='"')
    return ingest(spark, "csv", source, DOCUMENTS, reader={"multiline": True, "extra": {"escape": '"'}})


@query("SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations")
def ingest_json_multiline(spark: SparkSession, sf: str) -> DataFrame:
    """Files of up to a few thousand turns, each an array over many lines."""
    source = scratch_path(spark, "conversations-json")
    turns = table(spark, sf, "conversations").select(
        F.expr("concat(conv_id DIV 100, '-', turn DIV 50)").alias("file"),
        F.struct("conv_id", "turn", "role", "text").alias("turn"),
    )
    files = turns.groupBy("file").agg(F.to_json(F.collect_list("turn"), {"pretty": "true"}).alias("value"))
    files.write.partitionBy("file").text(source)
    reader = {"multiline": True, "recursive": True}
    return ingest(spark, "json", source, ["conv_id", "turn", "role", "text"], reader=reader)


@query(f"SELECT {ORDERS_AS_TEXT}, {_SOME_DASHED} FROM orders")
def ingest_text(spark: SparkSession, sf: str) -> DataFrame:
    source = scratch_path(spark, "orders-text")
    orders_text(spark, sf).na.fill("-").select(F.concat_ws("|", *ORDERS).alias("value")).write.text(source)
    return ingest(spark, "text", source, ORDERS, reader={"delimiter": "|"})


@query(f"SELECT {ORDERS_AS_TEXT}, {_SOME_EMPTY} FROM orders")
def ingest_text_regex(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces apart by any run of bars and semicolons; an empty piece stays empty."""
    source = scratch_path(spark, "orders-text")
    lines = orders_text(spark, sf).na.fill("").select(F.concat_ws(";|;", *ORDERS).alias("value"))
    lines.write.text(source)
    return ingest(spark, "text", source, ORDERS, reader={"delimiter": "[|;]+", "delimiter_is_regex": True})


LINES = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINES_AS_TEXT = ", ".join(
    "strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate" if n == "l_shipdate" else f"CAST({n} AS VARCHAR) AS {n}" for n in LINES
)


def lines_text(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitem as a file would hold it."""
    lines = table(spark, sf, "lineitem").withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    return lines.select(*LINES)


@query(f"SELECT {_LINES_AS_TEXT}, count(*) AS copies FROM lineitem GROUP BY ALL")
def ingest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs over a growing directory, the last with nothing new: every row lands once."""
    names = LINES
    source, schema = scratch_path(spark, "lineitem-csv"), schema_of(*names)
    job = Bronze(new_table("raw"), source, scratch_path(spark, "raw"), schema)
    rows = lines_text(spark, sf)
    open_lines = F.col("l_returnflag") == "N"
    for part in (rows.where(open_lines), rows.where(~open_lines), None):
        if part is not None:
            part.write.mode("append").csv(source, header=True)
        run_bronze(spark, job)
    # Copies are few: counted where they are read, each task would hold nearly all that it reads of the files.
    landed = read_table(spark, job.table, schema).repartition(*names)
    return landed.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))


@query(f"SELECT {_LINES_AS_TEXT}, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS line, true AS few_files FROM lineitem")
def compacted_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Many small batches by a partition value, whose files then are a few for each value; the newest batch is left alone."""
    source = scratch_path(spark, "lineitem-csv")
    lines = lines_text(spark, sf).withColumn("line", F.expr("lpad(CAST(l_linenumber AS STRING), 2, '0')"))
    lines.repartition(12).write.csv(source, header=True)
    job = Bronze(
        new_table("raw"), source, scratch_path(spark, "raw"), schema_of(*lines.columns), partitions=["line"],
        reader={"max_files_per_trigger": 2},
    )
    run_bronze(spark, job)
    counted = compact_bronze(spark, job)
    few = 2 * counted["files_after"] <= counted["files_before"]
    return read_table(spark, job.table, schema_of(*lines.columns)).withColumn("few_files", F.lit(few))


CUSTOMERS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_CUSTOMERS_AS_TEXT = """
    CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
    CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
"""


@query(f"SELECT {_CUSTOMERS_AS_TEXT} FROM customer")
def ingest_recursive(spark: SparkSession, sf: str) -> DataFrame:
    """Files in sub-directories, taken in batches of a few files."""
    source = scratch_path(spark, "customer-csv")
    customers = table(spark, sf, "customer").select(*CUSTOMERS, F.col("c_nationkey").alias("nation"))
    customers.repartition("nation").write.partitionBy("nation").csv(source, header=True)
    return ingest(spark, "csv", source, CUSTOMERS, reader={"recursive": True, "max_files_per_trigger": 10})


@query(f"SELECT {ORDERS_AS_TEXT}, {_SOME_NULL}, 0 AS passed_over FROM orders")
def ingest_archived(spark: SparkSession, sf: str) -> DataFrame:
    """Files that are moved away once read; later ones carry dates of years before."""
    source, schema = scratch_path(spark, "orders-csv"), schema_of(*ORDERS)
    job = Bronze(new_table("raw"), source, scratch_path(spark, "raw"), schema, archive=scratch_path(spark, "archive"))
    orders = orders_text(spark, sf)
    place = spark._jvm.org.apache.hadoop.fs.Path(source)
    files, known = place.getFileSystem(spark._jsc.hadoopConfiguration()), set()
    for part in range(3):
        orders.where(f"o_orderkey % 3 = {part}").write.mode("append").csv(source, header=True)
        for f in files.listStatus(place):
            if f.getPath().getName() not in known:
                known.add(f.getPath().getName())
                files.setTimes(f.getPath(), f.getModificationTime() - part * 400 * 86_400_000, -1)
        run_bronze(spark, job)
        run_bronze(spark, job)  # once more, without new files
    return read_table(spark, job.table, schema).withColumn("passed_over", F.lit(job.passed_over))


@query("SELECT * FROM lineitem")
def ingest_registered_source(spark: SparkSession, sf: str) -> DataFrame:
    """A file type added by the user: Parquet, with its own types."""
    register_source("parquet", lambda reader, path, schema, options: reader.schema(schema).parquet(path))
    source, home = scratch_path(spark, "lineitem-parquet"), scratch_path(spark, "typed")
    rows = table(spark, sf, "lineitem")
    rows.write.parquet(source)
    stream = read_new_files(spark, "parquet", source, rows.schema)
    append_new(stream, f"{home}/data", f"{home}/_checkpoint", ingest_date=None)
    return spark.read.schema(rows.schema).parquet(f"{home}/data").select(*rows.columns)


@query(f"SELECT {_CUSTOMERS_AS_TEXT} FROM customer WHERE c_mktsegment = 'BUILDING'")
def partitioned_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A filter on the partition column reads that partition's files only."""
    source = scratch_path(spark, "customer-csv")
    table(spark, sf, "customer").select(*CUSTOMERS).write.csv(source, header=True)
    raw = ingest(spark, "csv", source, CUSTOMERS, partitions=["c_mktsegment"])
    return raw.where("c_mktsegment = 'BUILDING'")


@query(f"SELECT {_LINES_AS_TEXT}, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS line FROM lineitem")
def gathered_files(spark: SparkSession, sf: str) -> DataFrame:
    """Few files for each partition; a partition value like 01 stays text."""
    source = scratch_path(spark, "lineitem-csv")
    lines = lines_text(spark, sf).withColumn("line", F.expr("lpad(CAST(l_linenumber AS STRING), 2, '0')"))
    lines.write.csv(source, header=True)
    return ingest(spark, "csv", source, lines.columns, partitions=["line"], tasks_per_file=4)


@query(f"SELECT {_CUSTOMERS_AS_TEXT}, true AS dated FROM customer")
def catalog_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table by its catalog name, load date included."""
    source = scratch_path(spark, "customer-csv")
    table(spark, sf, "customer").select(*CUSTOMERS).write.csv(source, header=True)
    job = Bronze(new_table("raw"), source, scratch_path(spark, "raw"), schema_of(*CUSTOMERS))
    scanned = read_table(spark, run_bronze(spark, job))
    return scanned.select(*CUSTOMERS, F.col("ingest_date").rlike(r"^\d{4}-\d\d-\d\d$").alias("dated"))


@query("SELECT *, o_totalprice * 2 AS doubled FROM orders")
def overwrite_from_itself(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced twice, the second time from itself and with other columns."""
    name, home = new_table("clean"), scratch_path(spark, "clean")
    orders = table(spark, sf, "orders")
    overwrite_table(orders, name, home)
    overwrite_table(read_table(spark, name).repartition("o_custkey"), name, home)
    changed = read_table(spark, name).selectExpr("*", "o_totalprice * 2 AS doubled")
    overwrite_table(changed, name, home, partitions=["o_orderpriority"])
    return read_table(spark, name)


@query("SELECT * FROM part")
def register_existing(spark: SparkSession, sf: str) -> DataFrame:
    """Files already there become a table; registering again changes nothing."""
    name, home = new_table("parts"), scratch_path(spark, "parts")
    table(spark, sf, "part").write.parquet(home)
    register(spark, name, home)
    register(spark, name, home)
    return read_table(spark, name)


@query(
    """
    WITH d AS (SELECT * REPLACE (CASE WHEN event_id % 5 <> 0 THEN CAST(value AS DECIMAL(12, 2)) END AS value) FROM events)
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(user_id AS VARCHAR) AS user_id, event_type,
           CAST(coalesce(value, (SELECT CAST(avg(value) AS DECIMAL(12, 2)) FROM d)) AS DOUBLE) AS value, props
    FROM d
    """
)
def clean_on_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A model fitted on a table cleans a stream of files."""
    raw = table(spark, sf, "events").selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS ts",
        "CAST(user_id AS STRING) AS user_id",
        "concat(' ', upper(event_type)) AS event_type",
        "CASE WHEN event_id % 5 <> 0 THEN CAST(CAST(value AS DECIMAL(12, 2)) AS STRING) END AS value",
        "props",
    )
    contract = {
        "convert_types": {"event_id": "bigint", "value": "decimal(12,2)"},
        "null_handling": {"value": "mean"},
        "normalize_text": ["event_type"],
    }
    model = build_pipeline(list(contract), contract).fit(raw)
    source, home = scratch_path(spark, "events-csv"), scratch_path(spark, "streamed")
    raw.write.csv(source, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"')
    stream = model.transform(read_new_files(spark, "csv", source, schema_of(*raw.columns), extra={"escape": '"'}))
    append_new(stream, f"{home}/data", f"{home}/_checkpoint", ingest_date=None)
    cleaned = spark.read.parquet(f"{home}/data").select(*raw.columns)
    return cleaned.withColumn("value", F.col("value").cast("double"))


@query("SELECT event_id, user_id, event_type, CAST(value AS DOUBLE) AS value, ts, 0 AS late FROM events")
def dedup_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events as they come in three deliveries that overlap, some twice in one, deduplicated on the way in."""
    source, home = scratch_path(spark, "events-json"), scratch_path(spark, "streamed")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").cast("string").alias("ts"))
    contract = {
        "convert_types": {"event_id": "bigint", "user_id": "bigint", "value": "double", "ts": "timestamp_ntz"},
        "remove_duplicates": {"subset_cols": ["event_id"]},
    }
    options = {"remove_duplicates": {"time": "ts", "within": "15 days"}}
    model = build_pipeline(list(contract), contract, options).fit(events)
    late = {}
    for first, last in ((1, 12), (10, 22), (20, 30)):
        part = events.where(F.dayofmonth(F.col("ts").cast("timestamp_ntz")).between(first, last))
        part.unionAll(part.where("event_id % 3 = 0")).write.mode("append").json(source)
        stream = model.transform(read_new_files(spark, "json", source, schema_of(*events.columns)))
        append_new(stream, f"{home}/data", f"{home}/_checkpoint", ingest_date=None, late=late)
    stored = spark.read.parquet(f"{home}/data").select(*events.columns)
    return stored.withColumn("late", F.lit(late["rows"]))


_FIELDS = ["CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)", "o_orderstatus",
           "CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS VARCHAR)", "strftime(o_orderdate, '%Y-%m-%d')", "o_orderpriority"]
_GOOD = "o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0"


def _quarantine_sql(kind: str, sep: str) -> str:
    if kind == "json":
        line = "'{' || " + " || ',' || ".join(f"""'"{n}":"' || {f} || '"'""" for n, f in zip(ORDERS, _FIELDS))
        reason = "'not a JSON object'"
    else:
        short = f" || '{sep}' || ".join(_FIELDS[:5])
        line = f"{short} || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '{sep}' || o_orderpriority || '{sep}more' END"
        reason = "'not 6 fields'" if kind == "csv" else "CASE WHEN o_orderkey % 11 = 0 THEN '5' ELSE '7' END || ' pieces, not 6'"
    fields = ", ".join(f"{f} AS {n}" for f, n in zip(_FIELDS, ORDERS))
    return f"""
        SELECT '{kind}' AS kind, {fields}, NULL AS text, NULL AS reason FROM orders WHERE {_GOOD}
        UNION ALL SELECT '{kind}', NULL, NULL, NULL, NULL, NULL, NULL, {line}, {reason} FROM orders WHERE NOT ({_GOOD})"""


_KINDS = {"csv": ";", "json": ",", "text": "|"}


@query(" UNION ALL ".join(_quarantine_sql(kind, sep) for kind, sep in _KINDS.items()))
def ingest_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a field too few or too many and JSON cut short, apart from the rows, in two deliveries."""
    orders = table(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS o_orderkey", "CAST(o_custkey AS STRING) AS o_custkey", "o_orderstatus",
        "CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS STRING) AS o_totalprice",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS o_orderdate", "o_orderpriority",
    )
    parts = []
    for kind, sep in _KINDS.items():
        if kind == "json":
            pairs = [F.concat(F.lit(f'"{n}":"'), F.col(n), F.lit('"')) for n in ORDERS]
            line = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.expr(f"IF({_GOOD}, '}}', '')"))
        else:
            last = F.expr(f"CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN {_GOOD} THEN o_orderpriority ELSE concat(o_orderpriority, '{sep}more') END")
            line = F.concat_ws(sep, *ORDERS[:5], last)
        source, reader = scratch_path(spark, f"orders-{kind}"), {} if kind == "json" else {"delimiter": sep}
        reader |= {"header": False} if kind == "csv" else {}
        job = Bronze(new_table("raw"), source, scratch_path(spark, "raw"), schema_of(*ORDERS), kind, reader=reader, quarantine=True)
        for part in (0, 1):
            orders.where(f"o_orderkey % 2 = {part}").select(line.alias("value")).write.mode("append").text(source)
            run_bronze(spark, job)
        rows = read_table(spark, job.table).select(*ORDERS)
        rejected = read_table(spark, f"{job.table}_rejected").select("text", "reason")
        parts.append(rows.unionByName(rejected, allowMissingColumns=True).withColumn("kind", F.lit(kind)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
