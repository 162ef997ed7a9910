"""Layer jobs, features and lemmatisation."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace_queries.ingest import new_table, orders_text, schema_of
from terrace_queries.registry import query, table
from terrace import Bronze, Gold, Silver, clean, read_table, run_bronze, run_layers, run_silver
from terrace.operators.features import (
    build_features,
    category_counts,
    entity_aggregates,
    join_features,
    time_window_aggregates,
)
from terrace.operators.as_of import join_as_of
from terrace.operators.frequent import FrequentCategories
from terrace.operators.lemmas import lemmatize
from terrace.operators.tiles import features_from_tiles, read_tiles, write_tiles
from terrace.scratch import scratch_path

_CLEAN_ORDERS = """
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(14, 2)) AS o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate,
           CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority ELSE 'none' END AS o_orderpriority
    FROM orders
"""
_ORDERS_CONTRACT = {
    "remove_duplicates": {"subset_cols": None},
    "convert_types": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_totalprice": "decimal(14,2)",
        "o_orderdate": "date",
    },
    "null_handling": {"o_orderpriority": "none"},
}


def _order_jobs(spark: SparkSession, sf: str) -> tuple[Bronze, Silver]:
    """Orders as CSV files, each row twice, into a raw and a clean table."""
    source = scratch_path(spark, "orders-csv")
    orders = orders_text(spark, sf)
    orders.unionAll(orders).write.csv(source, header=True)
    schema = schema_of(*orders.columns)
    raw = Bronze(new_table("raw"), source, scratch_path(spark, "raw"), schema, partitions=["o_orderstatus"])
    silver = Silver(new_table("clean"), raw.table, scratch_path(spark, "clean"), _ORDERS_CONTRACT, schema=schema)
    return raw, silver


@query(
    f"""
    SELECT * REPLACE (CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate)
    FROM ({_CLEAN_ORDERS})
    """
)
def bronze_to_silver(spark: SparkSession, sf: str) -> DataFrame:
    raw, silver = _order_jobs(spark, sf)
    run_bronze(spark, raw)
    orders = read_table(spark, run_silver(spark, silver))
    return orders.withColumns({n: F.col(n).cast("string") for n in ("o_totalprice", "o_orderdate")})


@query(
    f"""
    SELECT o_custkey, count(*) AS orders, CAST(sum(o_totalprice) AS DOUBLE) AS o_totalprice_sum,
           CAST(max(o_totalprice) AS DOUBLE) AS o_totalprice_max,
           count(DISTINCT o_orderdate) AS o_orderdate_count_distinct,
           count(*) FILTER (o_orderpriority = 'none') AS o_orderpriority_none
    FROM ({_CLEAN_ORDERS}) GROUP BY o_custkey
    """
)
def all_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Files to raw table, to clean table, to feature table, as one job per layer."""
    raw, silver = _order_jobs(spark, sf)
    features = [
        {
            "strategy": "entity_aggregates",
            "rows": "orders",
            "columns": {"o_totalprice": ["sum", "max"], "o_orderdate": ["count_distinct"]},
        },
        {"strategy": "category_counts", "category": "o_orderpriority", "values": ["none"]},
    ]
    gold = Gold(new_table("features"), scratch_path(spark, "features"), ["o_custkey"], {silver.table: features})
    *_, name = run_layers(spark, {"bronze": [raw], "silver": [silver], "gold": [gold]})
    table_ = read_table(spark, name)
    return table_.withColumns({c: F.col(c).cast("double") for c in ("o_totalprice_sum", "o_totalprice_max")})


@query(
    """
    SELECT 'convert_types' AS step, 'o_totalprice' AS name, count(*) FILTER (o_orderkey % 5 = 0) AS lost FROM orders
    UNION ALL SELECT 'convert_types', 'o_custkey', 0
    UNION ALL SELECT 'normalize_timestamp', 'o_orderdate', count(*) FILTER (o_orderkey % 3 = 0) FROM orders
    UNION ALL SELECT 'read', 'rows', count(*) FROM orders
    """
)
def lost_values(spark: SparkSession, sf: str) -> DataFrame:
    """How many values a lenient clean table has lost, and how many rows the raw one has read."""
    source = scratch_path(spark, "orders-csv")
    orders_text(spark, sf).withColumns(
        {
            "o_totalprice": F.expr("CASE WHEN o_orderkey % 5 = 0 THEN 'much' ELSE o_totalprice END"),
            "o_orderdate": F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 'soon' ELSE o_orderdate END"),
        }
    ).write.csv(source, header=True)
    schema = schema_of(*table(spark, sf, "orders").columns)
    raw = Bronze(new_table("raw"), source, scratch_path(spark, "raw"), schema)
    contract = {
        "remove_duplicates": {"subset_cols": None},
        "convert_types": {"o_custkey": "bigint", "o_totalprice": "decimal(14,2)"},
        "normalize_timestamp": {"input_col": "o_orderdate", "format": "yyyy-MM-dd"},
        "null_handling": {"o_totalprice": "mean"},
    }
    silver = Silver(new_table("clean"), raw.table, scratch_path(spark, "clean"), contract, list(contract), schema)
    run_layers(spark, {"bronze": [raw], "silver": [silver]})
    rows = [(step, name, n) for step, counts in silver.lost.items() for name, n in counts.items()]
    return spark.createDataFrame([*rows, ("read", "rows", raw.rows_read)], "step string, name string, lost bigint")


@query(
    """
    WITH came AS (
      SELECT *, 1 AS version FROM orders WHERE o_orderkey % 3 <> 0
      UNION ALL SELECT *, 2 FROM orders WHERE o_orderkey % 2 = 0
      UNION ALL SELECT *, 0 FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT *, 1 FROM orders WHERE o_orderkey % 3 = 0),
    latest AS (SELECT * FROM came QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1)
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CAST(CAST(o_totalprice AS DECIMAL(14, 2)) + 1000 * version AS VARCHAR) AS o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
           CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority ELSE 'none' END AS o_orderpriority, version
    FROM latest
    """
)
def silver_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches with newer, repeated and late older versions of orders, each cleaned as it comes."""
    source = scratch_path(spark, "orders-csv")
    orders = orders_text(spark, sf)

    def version(n: int) -> DataFrame:
        price = F.expr(f"CAST(CAST(o_totalprice AS DECIMAL(14, 2)) + {1000 * n} AS STRING)")
        return orders.withColumns({"o_totalprice": price, "version": F.lit(str(n))})

    newer = version(2).where("o_orderkey % 2 = 0")
    late = version(0).where("o_orderkey % 5 = 0").unionAll(version(1).where("o_orderkey % 3 = 0"))
    schema = schema_of(*orders.columns, "version")
    contract = _ORDERS_CONTRACT | {"remove_duplicates": {"subset_cols": ["o_orderkey"], "order_by": ["version desc"]}}
    contract["convert_types"] = contract["convert_types"] | {"version": "int"}
    raw = Bronze(new_table("raw"), source, scratch_path(spark, "raw"), schema)
    silver = Silver(new_table("clean"), raw.table, scratch_path(spark, "clean"), contract, schema=schema, buckets=16)
    for batch in (version(1).where("o_orderkey % 3 <> 0"), newer.unionAll(newer), late):
        batch.write.mode("append").csv(source, header=True)
        run_bronze(spark, raw)
        run_silver(spark, silver)
    cleaned = read_table(spark, silver.table, schema)
    return cleaned.withColumns({n: F.col(n).cast("string") for n in ("o_totalprice", "o_orderdate")})


@query(
    """
    WITH d AS (SELECT event_id, user_id, CASE WHEN event_id % 5 <> 0 THEN CAST(value AS DECIMAL(12, 2)) END AS value FROM events)
    SELECT event_id, user_id, CAST(coalesce(value, (SELECT CAST(avg(value) AS DECIMAL(12, 2)) FROM d)) AS DOUBLE) AS value,
           event_id % 4 = 0 AS missing, true AS near_the_median
    FROM d
    """
)
def fill_from_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A mean and a median of three batches, from their sums and sketches; the median is a percent off in rank at most."""
    source = scratch_path(spark, "events-csv")
    events = table(spark, sf, "events").selectExpr(
        "event_id", "user_id", "CASE WHEN event_id % 5 <> 0 THEN CAST(value AS DECIMAL(12, 2)) END AS value",
        "CASE WHEN event_id % 4 <> 0 THEN value END AS amount",
    )
    contract = {
        "convert_types": {"event_id": "bigint", "user_id": "bigint", "value": "decimal(12,2)", "amount": "double"},
        "null_handling": {"value": "mean", "amount": "median"},
    }
    raw = Bronze(new_table("raw"), source, scratch_path(spark, "raw"), schema_of(*events.columns), statistics=contract)
    for part in range(3):
        events.where(f"event_id % 3 = {part}").write.mode("append").csv(source, header=True)
        run_bronze(spark, raw)
    kept = f"{raw.base_path}/{raw.table.rpartition('.')[2]}/statistics"
    options = {"null_handling": {"statistics": kept}}
    silver = Silver(new_table("clean"), raw.table, scratch_path(spark, "clean"), contract, list(contract), raw.schema, options)
    cleaned = read_table(spark, run_silver(spark, silver))
    filled = F.when(F.col("event_id") % 4 == 0, F.col("amount"))
    known = cleaned.where("event_id % 4 <> 0").withColumn("median", cleaned.agg(F.max(filled).alias("m")).select("m").scalar())
    share = known.agg(F.avg((F.col("amount") < F.col("median")).cast("double")).alias("share")).select("share").scalar()
    return cleaned.select(
        "event_id", "user_id", F.col("value").cast("double").alias("value"), (F.col("event_id") % 4 == 0).alias("missing"),
        share.between(0.49, 0.51).alias("near_the_median"),
    )


_PRICE = "CAST(o_totalprice AS DECIMAL(14, 2))"


@query(
    f"""
    SELECT o_custkey, count(*) AS orders, count({_PRICE}) AS price_count, CAST(sum({_PRICE}) AS DOUBLE) AS price_sum,
           avg(o_orderkey) AS o_orderkey_avg, CAST(min({_PRICE}) AS DOUBLE) AS price_min,
           CAST(max({_PRICE}) AS DOUBLE) AS price_max,
           count(DISTINCT o_orderpriority) AS o_orderpriority_count_distinct
    FROM orders GROUP BY o_custkey
    """
)
def gold_entity_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(14,2)"))
    aggregates = entity_aggregates(
        {"price": ["count", "sum", "min", "max"], "o_orderkey": ["avg"], "o_orderpriority": ["count_distinct"]},
        rows="orders",
    )
    features = build_features(orders, ["o_custkey"], [aggregates])
    return features.withColumns({c: F.col(c).cast("double") for c in ("price_sum", "price_min", "price_max")})


def _windows_sql(days: list[int]) -> str:
    features = []
    for n in days:
        inside = f"ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL {n} DAY AND ts <= TIMESTAMP '2024-01-30 12:00:00'"
        features.append(f"count(*) FILTER ({inside}) AS rows_{n}d")
        features.append(f"CAST(sum(CAST(value AS DECIMAL(12, 2))) FILTER ({inside}) AS DOUBLE) AS amount_sum_{n}d")
        features.append(f"count(DISTINCT event_type) FILTER ({inside}) AS event_type_count_distinct_{n}d")
    return ", ".join(features)


@query(f"SELECT user_id, {_windows_sql([1, 7, 30])} FROM events GROUP BY user_id")
def gold_time_windows(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("amount", F.col("value").cast("decimal(12,2)"))
    windows = time_window_aggregates(
        "ts", "2024-01-30 12:00:00", [1, 7, 30], {"amount": ["sum"], "event_type": ["count_distinct"]}
    )
    features = build_features(events, ["user_id"], [windows])
    return features.withColumns({c: F.col(c).cast("double") for c in features.columns if "_sum_" in c})


_TYPES = ["click", "view", "purchase", "signup", "error"]
_TYPE_COUNTS = ", ".join(f"count(*) FILTER (event_type = '{t}') AS event_type_{t}" for t in _TYPES)


@query(f"SELECT user_id, {_TYPE_COUNTS} FROM events GROUP BY user_id")
def gold_category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return build_features(table(spark, sf, "events"), ["user_id"], [category_counts("event_type", _TYPES)])


_MIXED = "CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 7 <> 0 THEN props END"


@query(
    f"""
    WITH mixed AS (SELECT user_id, {_MIXED} AS kind FROM events),
    often AS (SELECT kind FROM mixed WHERE kind IS NOT NULL GROUP BY kind
              HAVING count(*) >= 0.03 * (SELECT count(kind) FROM mixed))
    SELECT user_id, {", ".join(f"count(*) FILTER (kind = '{t}' AND kind IN (FROM often)) AS kind_{t}" for t in _TYPES)},
           count(*) FILTER (kind IS NOT NULL AND kind NOT IN (FROM often)) AS kind_other
    FROM mixed GROUP BY user_id
    """
)
def gold_frequent_categories(spark: SparkSession, sf: str) -> DataFrame:
    """The few frequent ones of a hundred values, which no list names, and the rest as one."""
    events = table(spark, sf, "events").withColumn("kind", F.expr(_MIXED))
    return build_features(events, ["user_id"], [FrequentCategories("kind", 0.03)])


@query(
    f"""
    WITH a AS (SELECT user_id, {_TYPE_COUNTS}, {_windows_sql([7])} FROM events GROUP BY user_id),
         b AS (SELECT o_custkey AS user_id, count(*) AS orders, CAST(sum({_PRICE}) AS DOUBLE) AS price_sum
               FROM orders GROUP BY o_custkey)
    SELECT * FROM a FULL OUTER JOIN b USING (user_id)
    """
)
def gold_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """Features of two tables side by side; an entity in one of them only keeps its row."""
    events = table(spark, sf, "events").withColumn("amount", F.col("value").cast("decimal(12,2)"))
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_totalprice").cast("decimal(14,2)").alias("price")
    )
    windows = time_window_aggregates(
        "ts", "2024-01-30 12:00:00", [7], {"amount": ["sum"], "event_type": ["count_distinct"]}
    )
    keys = ["user_id"]
    joined = join_features(
        [
            build_features(events, keys, [category_counts("event_type", _TYPES), windows]),
            build_features(orders, keys, [entity_aggregates({"price": ["sum"]}, rows="orders")]),
        ],
        keys,
    )
    return joined.withColumns({c: F.col(c).cast("double") for c in ("amount_sum_7d", "price_sum")})


@query(
    """
    WITH e AS (SELECT *, make_timestamp(epoch_us(TIMESTAMP '1995-01-01')
                      + 80 * (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01'))) AS moment FROM events),
         o AS (SELECT o_custkey AS user_id, o_orderdate, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus,
                      arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey, o_orderdate)
    SELECT event_id, e.user_id, event_type, value, props, ts, moment, o_orderkey, o_orderstatus, o_totalprice
    FROM e ASOF LEFT JOIN o ON e.user_id = o.user_id AND e.moment >= o.o_orderdate
    """
)
def gold_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Each event with its user's last order as of then, a month of events being spread over the years of orders."""
    moment = F.expr("TIMESTAMP_NTZ'1995-01-01 00:00:00' + 80 * (ts - TIMESTAMP_NTZ'2024-01-01 00:00:00')")
    events = table(spark, sf, "events").withColumn("moment", moment)
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "user_id")
    values = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    return join_as_of(events, orders, ["user_id"], "moment", "o_orderdate", values, ties=["o_orderkey"], slice_hours=24 * 90)


_INSTANTS = ["2024-01-10 12:00:00", "2024-01-20 00:00:00", "2024-01-30 18:30:00"]


def _tiles_sql(as_of: str) -> str:
    features = []
    for n in (1, 7):
        inside = f"ts > TIMESTAMP '{as_of}' - INTERVAL {n} DAY AND ts <= TIMESTAMP '{as_of}'"
        features.append(f"count(*) FILTER ({inside}) AS rows_{n}d, count(amount) FILTER ({inside}) AS amount_count_{n}d")
        features += [f"CAST({a}(amount) FILTER ({inside}) AS DOUBLE) AS amount_{a}_{n}d" for a in ("sum", "min", "max")]
        features.append(f"avg(event_id) FILTER ({inside}) AS event_id_avg_{n}d")
    return f"""SELECT '{as_of}' AS as_of, user_id, {", ".join(features)} FROM amounts
               WHERE ts > TIMESTAMP '{as_of}' - INTERVAL 7 DAY AND ts <= TIMESTAMP '{as_of}' GROUP BY user_id"""


@query(
    "WITH amounts AS (SELECT *, CAST(value AS DECIMAL(12, 2)) AS amount FROM events) " + " UNION ALL ".join(map(_tiles_sql, _INSTANTS))
)
def gold_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Features as of three instants from one table of tiles, whose last days were written after, and again."""
    events = table(spark, sf, "events").withColumn("amount", F.col("value").cast("decimal(12,2)"))
    columns = {"amount": ["count", "sum", "min", "max"], "event_id": ["avg"]}
    name, place = new_table("tiles"), scratch_path(spark, "tiles")
    for days in ("ts < '2024-01-16'", "ts >= '2024-01-14'"):
        write_tiles(events.where(days), name, place, ["user_id"], "ts", columns)
    tiles = read_tiles(spark, name)
    parts = []
    for as_of in _INSTANTS:
        features = features_from_tiles(tiles, events, ["user_id"], "ts", as_of, [1, 7], columns)
        parts.append(features.withColumn("as_of", F.lit(as_of)))
    whole = reduce(DataFrame.unionByName, parts)
    exact = [c for c in whole.columns if c.startswith("amount_") and "count" not in c]
    return whole.withColumns({c: F.col(c).cast("double") for c in exact})


@query(
    """
    WITH words AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token,
                          generate_subscripts(string_split(p_name, ' '), 1) AS position FROM part),
    dictionary AS (SELECT DISTINCT token, token || '_' || length(token) AS lemma FROM words WHERE length(token) % 2 = 0)
    SELECT w.p_partkey, string_agg(coalesce(lemma, w.token), ' ' ORDER BY position) AS p_name,
           any_value(p_brand) AS p_brand
    FROM words w LEFT JOIN dictionary d ON w.token = d.token JOIN part p ON p.p_partkey = w.p_partkey
    GROUP BY w.p_partkey
    """
)
def lemmatize_names(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    tokens = parts.select(F.explode(F.split("p_name", " ")).alias("token")).distinct()
    dictionary = tokens.where("length(token) % 2 = 0").selectExpr("token", "concat(token, '_', length(token)) AS lemma")
    view = f"lemmas_{uuid.uuid4().hex}"
    dictionary.createOrReplaceTempView(view)
    rules = {"lemmatize": {"key": "p_partkey", "text": "p_name", "dictionary": view}}
    return clean(parts, ["lemmatize"], rules)


_PLURALS = """
    WITH dictionary AS (
      SELECT DISTINCT token, token[:-2] AS lemma FROM (SELECT unnest(string_split(text, ' ')) AS token FROM documents)
      WHERE length(token) > 3 AND token LIKE '%s'),
    words AS (SELECT doc_id, unnest(string_split(text, ' ')) AS token,
                     generate_subscripts(string_split(text, ' '), 1) AS position FROM documents)
    SELECT w.doc_id, string_agg(coalesce(lemma, w.token), ' ' ORDER BY position) AS text, any_value(lang) AS lang,
           any_value(source) AS source, any_value(n_chars) AS n_chars
    FROM words w LEFT JOIN dictionary d ON w.token = d.token JOIN documents o ON o.doc_id = w.doc_id
    GROUP BY w.doc_id
"""


def _plurals(documents: DataFrame) -> DataFrame:
    """A dictionary that grows with the documents: words in s, less the s."""
    tokens = documents.select(F.explode(F.split("text", " ")).alias("token")).distinct()
    plurals = tokens.where("length(token) > 3 AND token LIKE '%s'")
    return plurals.selectExpr("token", "left(token, length(token) - 1) AS lemma")


@query(_PLURALS)
def lemmatize_texts(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    return lemmatize(documents, "doc_id", "text", _plurals(documents))


@query(_PLURALS)
def lemmatize_texts_merged(spark: SparkSession, sf: str) -> DataFrame:
    """As if the dictionary were too large to send to every executor."""
    documents = table(spark, sf, "documents")
    return lemmatize(documents, "doc_id", "text", _plurals(documents), broadcast_bytes=0)
