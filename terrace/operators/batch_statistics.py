"""What fills are learnt from, batch by batch: sums, counts and quantile sketches beside a raw table.

Each batch that is ingested leaves one row of them. Merged, they give the mean or median of all rows ever ingested
without a row being read again; a batch that is written again replaces its row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, NumericType

from terrace.contract import fill_rule, section
from terrace.functions import column, without_nan
from terrace.operators.base import require_columns
from terrace.operators.values import ConvertTypes

BATCH = "ingest_batch"
# The sketch's size for an approximate median that is off by one row in 250 at most, nearly always.
SIZE = math.ceil((2.3 * 250) ** (1 / 0.9))
# A task merges the sketches of so many others at most.
MERGED = 1024


def learnt_kinds(contract: Mapping[str, Any]) -> dict[str, str]:
    """The columns a contract fills with a mean or median, and which."""
    rules = {n: fill_rule(rule)[0] for n, rule in (section(contract, "null_handling") or {}).items()}
    return {n: kind for n, kind in rules.items() if kind != "constant"}


def _is_whole(dtype: DataType) -> bool:
    return isinstance(dtype, IntegralType)


def _sketched(v: Column, dtype: DataType) -> Column:
    if _is_whole(dtype):
        return F.kll_sketch_agg_bigint(v.cast("bigint"), F.lit(SIZE))
    return F.kll_sketch_agg_double(v.cast("double"), F.lit(SIZE))


def _merged(sketch: str, dtype: DataType) -> Column:
    return (F.kll_merge_agg_bigint if _is_whole(dtype) else F.kll_merge_agg_double)(column(sketch))


def statistics_of(rows: DataFrame, contract: Mapping[str, Any]) -> DataFrame:
    """One row with what the contract's means and medians need of these rows, once their types are converted.

    For a column ``c`` with a mean, ``c__total`` and ``c__rows``; with a median, ``c__sketch``. NaN and values that do
    not cast take no part. A column that is no number after ``convert_types`` is an error.
    """
    kinds = learnt_kinds(contract)
    require_columns(rows, kinds)
    types = {n: t for n, t in (section(contract, "convert_types") or {}).items() if n in kinds}
    typed = ConvertTypes({"convert_types": types}).transform(rows.select(*[column(n) for n in kinds]))
    near, far = [], []
    for n, kind in kinds.items():
        dtype = typed.schema[n].dataType
        if not isinstance(dtype, NumericType):
            raise ValueError(f"column '{n}' is {dtype.simpleString()}: convert it to a number before taking its {kind}")
        v = without_nan(n, dtype)
        if kind == "mean":
            exact = v if isinstance(dtype, DecimalType) else v.cast("double")
            near += [F.sum(exact).alias(f"{n}__total"), F.count(v).alias(f"{n}__rows")]
            far += [F.sum(column(f"{n}__{part}")).alias(f"{n}__{part}") for part in ("total", "rows")]
        else:
            near.append(_sketched(v, dtype).alias(f"{n}__sketch"))
            far.append(_merged(f"{n}__sketch", dtype).alias(f"{n}__sketch"))
    if not near:
        raise ValueError("the contract takes no mean and no median")
    return typed.groupBy(F.floor(F.spark_partition_id() / MERGED).alias("group")).agg(*near).agg(*far)


def write_statistics(rows: DataFrame, batch: int, location: str, contract: Mapping[str, Any]) -> None:
    """Put a batch's statistics beside the others', or in the place of its own."""
    found = statistics_of(rows, contract).coalesce(1).withColumn(BATCH, F.lit(str(batch)))
    writer = found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BATCH).parquet(location)


def fills_from(spark: SparkSession, location: str, kinds: Mapping[str, str], types: Mapping[str, DataType]) -> dict[str, str | None]:
    """The mean or median of each column over all batches, in the given type, as text; null where there is no value."""
    stored = spark.read.parquet(location)
    suffix = {"mean": ("total", "rows"), "median": ("sketch",)}
    require_columns(stored, [f"{n}__{part}" for n, kind in kinds.items() for part in suffix[kind]])
    found = []
    for n, kind in kinds.items():
        if kind == "mean":
            v = F.try_divide(F.sum(column(f"{n}__total")), F.sum(column(f"{n}__rows")))
        else:
            whole = _is_whole(types[n])
            merged = _merged(f"{n}__sketch", types[n])
            count = (F.kll_sketch_get_n_bigint if whole else F.kll_sketch_get_n_double)(merged)
            middle = F.kll_sketch_get_quantile_bigint if whole else F.kll_sketch_get_quantile_double
            v = F.when(count > 0, middle(merged, F.lit(0.5)))
        found.append(v.cast(types[n]).cast("string"))
    return dict(zip(kinds, stored.agg(*found).first(), strict=True))
