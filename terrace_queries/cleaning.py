"""The cleaning steps, one query each, and several in order.

The test tables hold no nulls and little dirt, so each query makes its own by rule, over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace_queries.registry import query, table
from terrace import build_pipeline, clean, register_step
from terrace.functions import column, split_by_position
from terrace.operators import HandleNulls, Step

EXACT = {"null_handling": {"exact_median": True}}


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their labels; most have none, which leaves nulls."""
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")


@query("SELECT DISTINCT * FROM lineitem")
def dedup_all(spark: SparkSession, sf: str) -> DataFrame:
    """Whole rows, each there twice."""
    df = table(spark, sf, "lineitem")
    return clean(df.unionAll(df), ["remove_duplicates"], {"remove_duplicates": {"subset_cols": None}})


@query("SELECT DISTINCT text, lang, source FROM documents")
def dedup_texts(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "documents").select("text", "lang", "source")
    return clean(df, ["remove_duplicates"], {})


@query("SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1")
def dedup_keys(spark: SparkSession, sf: str) -> DataFrame:
    rules = {"remove_duplicates": {"subset_cols": ["o_custkey"], "order_by": ["o_orderkey"]}}
    return clean(table(spark, sf, "orders"), ["remove_duplicates"], rules)


@query(
    "SELECT * FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1"
)
def dedup_keys_latest(spark: SparkSession, sf: str) -> DataFrame:
    rules = {"remove_duplicates": {"subset_cols": ["user_id", "event_type"], "order_by": ["ts desc", "event_id"]}}
    return clean(table(spark, sf, "events"), ["remove_duplicates"], rules)


@query("SELECT l_orderkey, l_linenumber, true AS is_a_row FROM lineitem GROUP BY ALL")
def dedup_keys_any(spark: SparkSession, sf: str) -> DataFrame:
    """Which row of a key stays is arbitrary; the keys that stay are not, and each row is one of the table's."""
    rows = table(spark, sf, "lineitem")
    kept = clean(rows, ["remove_duplicates"], {"remove_duplicates": {"subset_cols": ["l_orderkey", "l_linenumber"]}})
    known = rows.distinct().withColumn("is_a_row", F.lit(True))
    checked = kept.join(known, rows.columns, "left")
    return checked.select("l_orderkey", "l_linenumber", F.coalesce("is_a_row", F.lit(False)).alias("is_a_row"))


@query(
    "SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id "
    "WHERE quality IS NOT NULL AND toxic IS NOT NULL"
)
def dropna_any(spark: SparkSession, sf: str) -> DataFrame:
    rules = {"remove_nulls": {"subset_cols": ["quality", "toxic"], "how": "any"}}
    return clean(_labelled(spark, sf), ["remove_nulls"], rules)


@query(
    """
    SELECT * FROM (
      SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN user_id END AS a,
             CASE WHEN event_id % 5 <> 0 THEN value END AS b
      FROM events)
    WHERE a IS NOT NULL OR b IS NOT NULL
    """
)
def dropna_all(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 3 <> 0 THEN user_id END AS a",
        "CASE WHEN event_id % 5 <> 0 THEN value END AS b",
    )
    return clean(df, ["remove_nulls"], {"remove_nulls": {"subset_cols": ["a", "b"], "how": "all"}})


@query(
    """
    SELECT event_id, TRY_CAST(u AS INTEGER) AS user_id, value, CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) AS amount,
           date_trunc('second', ts) AS at, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, TRY_CAST(flag AS BOOLEAN) AS flag
    FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN 'x' || user_id ELSE CAST(user_id AS VARCHAR) END AS u,
                 CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'maybe' END AS flag
          FROM events)
    """
)
def convert_types(spark: SparkSession, sf: str) -> DataFrame:
    text = table(spark, sf, "events").selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CASE WHEN event_id % 7 = 0 THEN concat('x', user_id) ELSE CAST(user_id AS STRING) END AS user_id",
        "CAST(value AS STRING) AS value",
        "CAST(value AS STRING) AS amount",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS at",
        "date_format(ts, 'yyyy-MM-dd') AS day",
        "CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'maybe' END AS flag",
    )
    types = {
        "event_id": "bigint",
        "user_id": "integer",
        "value": "double",
        "amount": "decimal(12,2)",
        "at": "timestamp_ntz",
        "day": "date",
        "flag": "boolean",
    }
    converted = clean(text, ["convert_types"], {"convert_types": types})
    return converted.withColumns({n: F.col(n).cast("string") for n in ("amount", "day")})


@query(
    """
    WITH d AS (SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events)
    SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM d)), 6) AS value FROM d
    """
)
def fill_mean(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").selectExpr("event_id", "CASE WHEN event_id % 5 <> 0 THEN value END AS value")
    filled = clean(df, ["null_handling"], {"null_handling": {"value": "mean"}})
    return filled.select("event_id", F.round("value", 6).alias("value"))


@query(
    """
    WITH d AS (SELECT l_orderkey, l_partkey, CASE WHEN l_partkey % 4 <> 0 THEN l_linenumber END AS n FROM lineitem)
    SELECT l_orderkey, l_partkey, coalesce(n, CAST(trunc((SELECT avg(n) FROM d)) AS INTEGER)) AS n FROM d
    """
)
def fill_mean_int(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "CASE WHEN l_partkey % 4 <> 0 THEN l_linenumber END AS n"
    )
    return clean(df, ["null_handling"], {"null_handling": {"n": "mean"}})


@query(
    """
    WITH d AS (SELECT l_orderkey, l_partkey, CASE WHEN l_partkey % 4 <> 0 THEN l_extendedprice END AS price,
                      CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END AS quantity FROM lineitem)
    SELECT l_orderkey, l_partkey, coalesce(price, (SELECT quantile_disc(price, 0.5) FROM d)) AS price,
           coalesce(quantity, (SELECT quantile_disc(quantity, 0.5) FROM d)) AS quantity FROM d
    """
)
def fill_median(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "CASE WHEN l_partkey % 4 <> 0 THEN l_extendedprice END AS price",
        "CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END AS quantity",
    )
    return clean(df, ["null_handling"], {"null_handling": {"price": "median", "quantity": "median"}}, EXACT)


_NANOS = "1700000000000000000 + event_id * 1000003"


@query(
    f"""
    WITH d AS (SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN {_NANOS} END AS nanos FROM events)
    SELECT event_id, coalesce(nanos, (SELECT quantile_disc(nanos, 0.5) FROM d)) AS nanos FROM d
    """
)
def fill_median_long(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers that doubles do not hold."""
    df = table(spark, sf, "events").selectExpr("event_id", f"CASE WHEN event_id % 4 <> 0 THEN {_NANOS} END AS nanos")
    return clean(df, ["null_handling"], {"null_handling": {"nanos": "median"}}, EXACT)


@query(
    "SELECT count(*) AS filled, true AS within_one_percent FROM lineitem WHERE l_partkey % 4 = 0"
)
def fill_median_approx(spark: SparkSession, sf: str) -> DataFrame:
    """The approximate median is a value of the column, at most one percent of the rows off the middle."""
    df = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "CASE WHEN l_partkey % 4 <> 0 THEN l_extendedprice END AS v"
    )
    filled = clean(df.withColumn("was", F.col("v")), ["null_handling"], {"null_handling": {"v": "median"}})
    median = filled.where("was IS NULL").agg(F.count("v").alias("filled"), F.max("v").alias("median"))
    ranks = df.withColumn("median", median.select("median").scalar()).agg(
        F.count("v").alias("rows"),
        F.count_if(F.col("v") < F.col("median")).alias("less"),
        F.count_if(F.col("v") <= F.col("median")).alias("up_to"),
    )
    low, high = F.col("less") <= 0.51 * F.col("rows"), F.col("up_to") >= 0.49 * F.col("rows")
    return ranks.select(median.select("filled").scalar().alias("filled"), (low & high).alias("within_one_percent"))


@query(
    """
    SELECT d.* REPLACE (CASE WHEN lang = 'en' THEN 'unknown' ELSE lang END AS lang),
           coalesce(quality, 0) AS quality, coalesce(toxic, -1) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """
)
def fill_constant(spark: SparkSession, sf: str) -> DataFrame:
    df = _labelled(spark, sf).withColumn("lang", F.expr("nullif(lang, 'en')"))
    return clean(df, ["null_handling"], {"null_handling": {"quality": 0, "toxic": "-1", "lang": "unknown"}})


@query(
    """
    WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS price,
                      CASE WHEN o_orderkey % 6 <> 0 THEN o_custkey END AS customer FROM orders)
    SELECT o_orderkey, round(coalesce(price, (SELECT avg(price) FROM d)), 4) AS price,
           coalesce(customer, (SELECT quantile_disc(customer, 0.5) FROM d)) AS customer FROM d
    """
)
def fill_by_model(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics learnt by ``fit``, applied by the model."""
    df = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS price",
        "CASE WHEN o_orderkey % 6 <> 0 THEN o_custkey END AS customer",
    )
    model = HandleNulls({"null_handling": {"price": "mean", "customer": "median"}}, exact_median=True).fit(df)
    return model.transform(df).select("o_orderkey", F.round("price", 4).alias("price"), "customer")


@query(
    """
    SELECT 'l_quantity' AS name, 'mean' AS kind, round(avg(l_quantity), 6) AS value FROM lineitem
    UNION ALL SELECT 'l_extendedprice', 'median', quantile_disc(l_extendedprice, 0.5) FROM lineitem
    UNION ALL SELECT 'l_discount', 'mean', round(avg(l_discount), 6) FROM lineitem
    """
)
def learned_statistics(spark: SparkSession, sf: str) -> DataFrame:
    kinds = {"l_quantity": "mean", "l_extendedprice": "median", "l_discount": "mean"}
    model = HandleNulls({"null_handling": kinds}, exact_median=True).fit(table(spark, sf, "lineitem"))
    learned = model.getOrDefault("learned")
    rows = [(n, k, round(float(learned[n]), 6)) for n, k in kinds.items()]
    return spark.createDataFrame(rows, "name string, kind string, value double")


@query("SELECT doc_id, lower(trim('  ' || text || ' ')) AS text, lower(trim(' ' || source)) AS source FROM documents")
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "documents").selectExpr(
        "doc_id", "concat('  ', text, ' ') AS text", "concat(' ', upper(source)) AS source"
    )
    return clean(df, ["normalize_text"], {"normalize_text": ["text", "source"]})


@query(
    """
    SELECT event_id, try_strptime(CASE WHEN event_id % 11 = 0 THEN 'bad' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END,
                                  '%Y-%m-%d %H:%M:%S') AS at,
           strptime(strftime(ts, '%d/%m/%Y %H:%M'), '%d/%m/%Y %H:%M') AS minute
    FROM events
    """
)
def normalize_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 11 = 0 THEN 'bad' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS at",
        "date_format(ts, 'dd/MM/yyyy HH:mm') AS minute",
    )
    rules = [{"input_col": "at"}, {"input_col": "minute", "format": "dd/MM/yyyy HH:mm"}]
    parsed = clean(df, ["normalize_timestamp"], {"normalize_timestamp": rules})
    return parsed.withColumns({n: F.col(n).cast("timestamp_ntz") for n in ("at", "minute")})


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS a, CAST(o_custkey AS VARCHAR) AS b,
           CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS c
    FROM orders
    """
)
def split_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of two, three or four pieces, by a delimiter that means something else as a pattern."""
    lines = table(spark, sf, "orders").selectExpr(
        """concat_ws('||', o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END,
                     CASE WHEN o_orderkey % 3 = 1 THEN 'extra' END) AS value"""
    )
    return split_by_position(lines, ["a", "b", "c"], "||")


@query(
    """
    WITH d AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT DISTINCT doc_id, text, lang, source, n_chars, CAST(quality AS BIGINT) AS quality,
           coalesce(CAST(toxic AS VARCHAR), 'none') AS toxic
    FROM (SELECT * REPLACE (coalesce(quality, (SELECT round(avg(quality)) FROM d)) AS quality) FROM d)
    """
)
def silver_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicate, convert, fill: the order a clean table is made in by default."""
    raw = _labelled(spark, sf).withColumn("quality", F.col("quality").cast("string"))
    contract = {
        "remove_duplicates": {"subset_cols": None},
        "convert_types": {"quality": "decimal(18,0)", "toxic": "string"},
        "null_handling": {"quality": "mean", "toxic": "none"},
    }
    steps = ["remove_duplicates", "convert_types", "null_handling"]
    cleaned = clean(raw.unionAll(raw), steps, contract)
    return cleaned.withColumn("quality", F.col("quality").cast("bigint"))


_ALL_STEPS = {
    "remove_duplicates": {"subset_cols": ["event_id"], "order_by": ["value"]},
    "normalize_text": ["event_type"],
    "normalize_timestamp": {"input_col": "seen_at", "format": "yyyy-MM-dd HH:mm:ss"},
    "convert_types": {"event_id": "bigint", "user_id": "integer", "value": "decimal(12,2)"},
    "remove_nulls": {"subset_cols": ["seen_at"], "how": "any"},
    "null_handling": {"user_id": 0, "value": "mean"},
}


_ALL_STEPS_SQL = """
    WITH d AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 0 ELSE user_id END AS user_id, event_type,
                      CASE WHEN event_id % 5 <> 0 THEN CAST(value AS DECIMAL(12, 2)) END AS value,
                      date_trunc('second', ts) AS seen_at
               FROM events WHERE event_id % 11 <> 0)
    SELECT event_id, CAST(user_id AS INTEGER) AS user_id, event_type, seen_at,
           CAST(coalesce(value, (SELECT CAST(avg(value) AS DECIMAL(12, 2)) FROM d)) AS DOUBLE) AS value FROM d
    """


def _raw_events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(user_id AS STRING) END AS user_id",
        "concat(' ', upper(event_type), '  ') AS event_type",
        "CASE WHEN event_id % 5 <> 0 THEN CAST(CAST(value AS DECIMAL(12, 2)) AS STRING) END AS value",
        "CASE WHEN event_id % 11 = 0 THEN 'bad' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS seen_at",
    )
    return events.unionAll(events)


def _comparable(df: DataFrame) -> DataFrame:
    return df.withColumns({"seen_at": F.col("seen_at").cast("timestamp_ntz"), "value": F.col("value").cast("double")})


@query(_ALL_STEPS_SQL)
def all_six_steps(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = clean(_raw_events(spark, sf), list(_ALL_STEPS), _ALL_STEPS)
    return _comparable(cleaned)


@query(_ALL_STEPS_SQL)
def fitted_steps(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a fitted ``pyspark.ml`` model."""
    raw = _raw_events(spark, sf)
    cleaned = build_pipeline(list(_ALL_STEPS), _ALL_STEPS).fit(raw).transform(raw)
    return _comparable(cleaned)


class UpperCase(Step):
    """A step as a user would write one."""

    section_name = "upper_case"

    def input_columns(self) -> list[str]:
        return list(self.rules or [])

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({n: F.upper(column(n)) for n in self.input_columns()})


@query("SELECT doc_id, text, upper(lang) AS lang, upper(source) AS source FROM documents")
def own_step(spark: SparkSession, sf: str) -> DataFrame:
    register_step("upper_case", UpperCase)
    df = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return clean(df, ["upper_case"], {"upper_case": ["lang", "source"]})
