"""Steps that rewrite columns in place, row by row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from terrace.contract import as_list
from terrace.functions import column, normalized_text, parsed_timestamp
from terrace.functions.text import DEFAULT_TIMESTAMP_FORMAT
from terrace.operators.base import Step


def _observed(df: DataFrame, observation: Observation, read: Mapping[str, Column]) -> DataFrame:
    """The table, with a count of the values of each column that are there but cannot be read."""
    lost = [F.count_if(column(n).isNotNull() & v.isNull()).alias(n) for n, v in read.items()]
    return df.observe(observation, *lost) if lost else df


class ConvertTypes(Step):
    """Cast the named columns to the named types.

    A value that does not cast becomes null, or fails the job with ``on_error="fail"``.
    """

    section_name = "convert_types"

    def input_columns(self) -> list[str]:
        return list(self.rules or {})

    def apply(self, df: DataFrame) -> DataFrame:
        strict = self.on_error == "fail"
        casts = {
            n: column(n).cast(t) if strict else column(n).try_cast(t) for n, t in (self.rules or {}).items()
        }
        return df.withColumns(casts) if casts else df

    def count_lost(self, df: DataFrame, observation: Observation) -> DataFrame:
        """Count, while the table is being computed anyway, the values each cast will turn to null."""
        return _observed(df, observation, {n: column(n).try_cast(t) for n, t in (self.rules or {}).items()})


class NormalizeText(Step):
    """Trim outer spaces and lower-case the listed columns."""

    section_name = "normalize_text"

    def input_columns(self) -> list[str]:
        return as_list(self.rules)

    def apply(self, df: DataFrame) -> DataFrame:
        names = self.input_columns()
        return df.withColumns({n: normalized_text(column(n)) for n in names}) if names else df


class NormalizeTimestamp(Step):
    """Parse text columns into timestamps: one ``{input_col, format}`` or a list of them."""

    section_name = "normalize_timestamp"

    def input_columns(self) -> list[str]:
        names = [r.get("input_col") for r in as_list(self.rules)]
        if not all(isinstance(n, str) for n in names):
            raise ValueError("normalize_timestamp needs an input_col")
        return names

    def _parsed(self, on_error: str) -> dict[str, Column]:
        return {
            r["input_col"]: parsed_timestamp(column(r["input_col"]), r.get("format") or DEFAULT_TIMESTAMP_FORMAT, on_error)
            for r in as_list(self.rules)
        }

    def apply(self, df: DataFrame) -> DataFrame:
        parsed = self._parsed(self.on_error)
        return df.withColumns(parsed) if parsed else df

    def count_lost(self, df: DataFrame, observation: Observation) -> DataFrame:
        """Count, while the table is being computed anyway, the values that will not parse."""
        return _observed(df, observation, self._parsed("null"))
