"""What every cleaning step has in common."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from terrace.contract import section

ON_ERROR = ("null", "fail")


def require_dataframe(df: Any) -> None:
    if not isinstance(df, DataFrame):
        raise ValueError(f"the input must be a DataFrame, not {type(df).__name__}")


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    present = set(df.columns)
    missing = [n for n in names if n not in present]
    if missing:
        raise ValueError("no such column: " + ", ".join(f"'{n}'" for n in missing))


class HasRules(Params):
    """Holds the contract and hands out the step's own section of it.

    The contract is a ``Param``, so that steps and fitted models can be saved and loaded.
    """

    contract: Param = Param(Params._dummy(), "contract", "the cleaning contract, one section per step")
    onError: Param = Param(Params._dummy(), "onError", "null or fail: what a value that cannot be read becomes")

    section_name: str = ""

    def __init__(self, contract: Mapping[str, Any] | None = None, on_error: str = "null"):
        super().__init__()
        if on_error not in ON_ERROR:
            raise ValueError(f"on_error must be null or fail, not '{on_error}'")
        self._set(contract=dict(contract or {}), onError=on_error)

    @property
    def rules(self) -> Any:
        return section(self.getOrDefault("contract"), self.section_name)

    @property
    def on_error(self) -> str:
        return self.getOrDefault("onError")


class Step(HasRules, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A cleaning step: a table in, a table out. Subclass it, name the section, write ``apply``."""

    def input_columns(self) -> list[str]:
        """Columns that must exist."""
        return []

    def apply(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        require_dataframe(dataset)
        require_columns(dataset, self.input_columns())
        return self.apply(dataset)
