"""Filling nulls, with constants or with what the table itself says."""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, NumericType, StringType

from terrace.contract import fill_rule
from terrace.functions import column, unused_name, without_nan
from terrace.operators.base import HasRules, require_columns, require_dataframe
from terrace.operators.batch_statistics import fills_from
from terrace.operators.median import exact_medians

ON_EMPTY = ("fail", "keep")
# The approximate median is off by one row in so many at most, nearly always: 0.4 percent. A sketch then has some 20 kB.
ACCURACY = 250
# A task merges the sketches of so many others at most, up to a million tasks.
MERGED = 1024


def _fill(df: DataFrame, fills: Mapping[str, Column]) -> DataFrame:
    """Put ``fills[name]`` wherever ``name`` is null or NaN, in the column's own type."""
    schema = df.schema
    filled = {
        n: F.coalesce(without_nan(n, schema[n].dataType), v.cast(schema[n].dataType)) for n, v in fills.items()
    }
    return df.withColumns(filled) if filled else df


def _values(name: str, kind: str, dtype: DataType) -> Column:
    """What a mean or median is taken of; NaN takes no part in it."""
    if isinstance(dtype, NumericType):
        return without_nan(name, dtype)
    if isinstance(dtype, StringType) and kind == "mean":
        numbers = column(name).try_cast("double")
        return F.nanvl(numbers, F.lit(None).cast("double"))
    raise ValueError(f"column '{name}' is {dtype.simpleString()}: convert it to a number before taking its {kind}")


def _learned(df: DataFrame, kinds: Mapping[str, str], accuracy: int) -> DataFrame:
    """One row: the mean or approximate median of each column, in its type, as ``s0``, ``s1`` ..

    For medians, every task sketches its rows; the sketches of ``MERGED`` neighbouring tasks are merged first, and
    then what these merges give, so that no task reads more than a fixed number of others' sketches. Sums and
    counts for the means go along. As the groups of tasks are what they are in a run, Spark takes the row for one
    that may differ: filters are not pushed below a fill with it, and it cannot stand inside an aggregate.
    """
    types = {n: df.schema[n].dataType for n in kinds}
    values = {n: _values(n, k, types[n]) for n, k in kinds.items()}
    if "median" not in kinds.values():
        return df.agg(*[F.avg(v).cast(types[n]).alias(f"s{i}") for i, (n, v) in enumerate(values.items())])
    size = F.lit(min(65535, max(64, math.ceil((2.3 * accuracy) ** (1 / 0.9)))))
    near, far = [], []
    for i, (n, kind) in enumerate(kinds.items()):
        a = f"s{i}"
        if kind == "mean":
            v = values[n] if isinstance(types[n], DecimalType) else values[n].cast("double")
            near += [F.sum(v).alias(a), F.count(v).alias(f"{a}_rows")]
            found = F.try_divide(F.sum(a), F.sum(f"{a}_rows"))
        elif isinstance(types[n], IntegralType):
            near.append(F.kll_sketch_agg_bigint(values[n].cast("bigint"), size).alias(a))
            merged = F.kll_merge_agg_bigint(F.col(a))
            found = F.when(F.kll_sketch_get_n_bigint(merged) > 0, F.kll_sketch_get_quantile_bigint(merged, F.lit(0.5)))
        else:
            near.append(F.kll_sketch_agg_double(values[n].cast("double"), size).alias(a))
            merged = F.kll_merge_agg_double(F.col(a))
            found = F.when(F.kll_sketch_get_n_double(merged) > 0, F.kll_sketch_get_quantile_double(merged, F.lit(0.5)))
        far.append(found.cast(types[n]).alias(a))
    return df.groupBy(F.floor(F.spark_partition_id() / MERGED).alias("group")).agg(*near).agg(*far)


def _nothing_to_learn(names: list[str]) -> str:
    return "no value to take a mean or median of in: " + ", ".join(names)


class HandleNulls(HasRules, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fill nulls by mean, median or a constant, column by column.

    All means and medians come from one aggregation, whatever the number of columns. ``fit`` runs
    it and gives a model that can be saved and used on other tables and on streams;
    ``fill_in_one_plan`` leaves it inside the plan instead, so that a shuffle before this step
    (deduplication) runs once for both the statistics and the rows.

    The median is approximate (rank error 1/``accuracy``) unless ``exact_median``. A column with
    nothing but nulls fails, or stays as it is with ``on_empty="keep"``. With ``statistics``, where ``run_bronze`` keeps
    those of its batches, means and medians are those of all rows ingested, and the table is not read for them.
    """

    section_name = "null_handling"

    exactMedian: Param = Param(Params._dummy(), "exactMedian", "take the exact median, in several passes")
    accuracy: Param = Param(Params._dummy(), "accuracy", "the approximate median is off by 1/accuracy in rank at most")
    onEmpty: Param = Param(Params._dummy(), "onEmpty", "fail or keep: what to do where there is nothing to learn")
    statistics: Param = Param(Params._dummy(), "statistics", "where the statistics of the batches ingested are, if anywhere")

    def __init__(
        self,
        contract: Mapping[str, Any] | None = None,
        on_error: str = "null",
        exact_median: bool = False,
        accuracy: int = ACCURACY,
        on_empty: str = "fail",
        statistics: str | None = None,
    ):
        super().__init__(contract, on_error)
        if statistics and exact_median:
            raise ValueError("the statistics of batches give no exact median")
        if on_empty not in ON_EMPTY:
            raise ValueError(f"on_empty must be fail or keep, not '{on_empty}'")
        self._set(exactMedian=exact_median, accuracy=accuracy, onEmpty=on_empty, statistics=statistics or "")

    def _split(self, df: DataFrame) -> tuple[dict[str, str], dict[str, Any]]:
        """The columns to learn, with their kind, and the constants; both checked against the table."""
        require_dataframe(df)
        rules = {n: fill_rule(s) for n, s in (self.rules or {}).items()}
        require_columns(df, rules)
        learned = {n: kind for n, (kind, _) in rules.items() if kind != "constant"}
        constants = {n: c for n, (kind, c) in rules.items() if kind == "constant"}
        if learned and df.isStreaming and not self.getOrDefault("statistics"):
            raise ValueError("means and medians are learnt from a table, not a stream: fit first, then use the model")
        for n, kind in learned.items():
            _values(n, kind, df.schema[n].dataType)
        self._check_constants(df, constants)
        return learned, constants

    @staticmethod
    def _check_constants(df: DataFrame, constants: Mapping[str, Any]) -> None:
        doubtful = {
            n: df.schema[n].dataType
            for n, c in constants.items()
            if isinstance(c, str) and not isinstance(df.schema[n].dataType, StringType)
        }
        if doubtful:
            read = df.sparkSession.range(1).select(*[F.lit(constants[n]).try_cast(t) for n, t in doubtful.items()])
            for (n, t), value in zip(doubtful.items(), read.first(), strict=True):
                if value is None:
                    raise ValueError(f"'{constants[n]}' cannot fill column '{n}' of type {t.simpleString()}")

    def _exact(self, df: DataFrame, learned: Mapping[str, str]) -> dict[str, str]:
        names = [n for n, kind in learned.items() if kind == "median"] if self.getOrDefault("exactMedian") else []
        found = exact_medians(df, names) if names else {}
        return {n: None if v is None else str(v) for n, v in found.items()}

    def _row(self, df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
        return _learned(df, kinds, self.getOrDefault("accuracy"))

    def _fit(self, dataset: DataFrame) -> HandleNullsModel:
        learned, constants = self._split(dataset)
        if place := self.getOrDefault("statistics"):
            types = {n: dataset.schema[n].dataType for n in learned}
            values = fills_from(dataset.sparkSession, place, learned, types) if learned else {}
            return HandleNullsModel(self._checked(values), constants)
        values = self._exact(dataset, learned)
        if one_pass := {n: k for n, k in learned.items() if n not in values}:
            row = self._row(dataset, one_pass)
            found = row.select(*[F.col(c).cast("string") for c in row.columns]).first()
            values.update(zip(one_pass, found, strict=True))
        return HandleNullsModel(self._checked(values), constants)

    def _checked(self, values: Mapping[str, str | None]) -> dict[str, str]:
        empty = [n for n, v in values.items() if v is None]
        if empty and self.getOrDefault("onEmpty") == "fail":
            raise ValueError(_nothing_to_learn(empty))
        return {n: v for n, v in values.items() if v is not None}

    def fill_in_one_plan(self, df: DataFrame) -> DataFrame:
        """Fill from a scalar sub-query over the same table; nothing runs until the result is used."""
        if self.getOrDefault("statistics"):
            return self._fit(df).transform(df)
        learned, constants = self._split(df)
        exact = self._exact(df, learned)
        fills = {n: F.lit(c) for n, c in constants.items()}
        fills |= {n: F.lit(v) for n, v in self._checked(exact).items()}
        if one_pass := {n: k for n, k in learned.items() if n not in exact}:
            row = self._row(df, one_pass)
            # One column holds the sub-query for all fills: named in each, it would be planned for each.
            learnt = unused_name(df, "learnt")
            filled = df.withColumn(learnt, row.select(F.struct(*row.columns)).scalar())
            for i, n in enumerate(one_pass):
                fills[n] = column(learnt)[f"s{i}"]
                if self.getOrDefault("onEmpty") == "fail":
                    problem = F.raise_error(F.lit(_nothing_to_learn([n]))).cast(df.schema[n].dataType)
                    fills[n] = F.coalesce(fills[n], problem)
            return _fill(filled, fills).drop(learnt)
        return _fill(df, fills)


class HandleNullsModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """The fills of a fitted ``HandleNulls``: a narrow projection, for tables and streams alike."""

    learned: Param = Param(Params._dummy(), "learned", "column to learnt value, as text")
    constants: Param = Param(Params._dummy(), "constants", "column to constant")

    def __init__(self, learned: Mapping[str, str] | None = None, constants: Mapping[str, Any] | None = None):
        super().__init__()
        self._set(learned=dict(learned or {}), constants=dict(constants or {}))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        require_dataframe(dataset)
        fills = self.getOrDefault("learned") | self.getOrDefault("constants")
        require_columns(dataset, fills)
        return _fill(dataset, {n: F.lit(v) for n, v in fills.items()})
