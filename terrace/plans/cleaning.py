"""Ordered cleaning steps, by name."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Estimator, Pipeline, Transformer
from pyspark.sql import DataFrame, Observation

from terrace.operators import (
    ConvertTypes,
    HandleNulls,
    Lemmatize,
    NormalizeText,
    NormalizeTimestamp,
    RemoveDuplicates,
    RemoveNulls,
)
from terrace.operators.base import require_dataframe

# The step names a contract and a job use.
STEPS: dict[str, type] = {
    "remove_duplicates": RemoveDuplicates,
    "remove_nulls": RemoveNulls,
    "convert_types": ConvertTypes,
    "null_handling": HandleNulls,
    "normalize_text": NormalizeText,
    "normalize_timestamp": NormalizeTimestamp,
    "lemmatize": Lemmatize,
}


BUILT_IN = frozenset(STEPS)


def register_step(name: str, step: type) -> None:
    """Add a step of your own: a ``Step`` subclass, or any stage class built from the contract."""
    if not (isinstance(step, type) and issubclass(step, (Transformer, Estimator))):
        raise ValueError(f"step '{name}' must be a Transformer or Estimator class")
    STEPS[name] = step


def build_stages(
    steps: Sequence[str], contract: Mapping[str, Any], options: Mapping[str, Mapping[str, Any]] | None = None
) -> list[Transformer | Estimator]:
    """One stage per name, in the caller's order, each given the whole contract.

    ``options`` holds further constructor arguments by step name, such as
    ``{"convert_types": {"on_error": "fail"}}``.
    """
    unknown = [s for s in steps if s not in STEPS]
    if unknown:
        raise ValueError("unknown step: " + ", ".join(f"'{s}'" for s in unknown))
    return [STEPS[s](contract, **(options or {}).get(s, {})) for s in steps]


def build_pipeline(
    steps: Sequence[str], contract: Mapping[str, Any], options: Mapping[str, Mapping[str, Any]] | None = None
) -> Pipeline:
    """The steps as a ``pyspark.ml.Pipeline``: fit it to get a model to save and to use on streams."""
    return Pipeline(stages=build_stages(steps, contract, options))


def clean(
    df: DataFrame,
    steps: Sequence[str],
    contract: Mapping[str, Any],
    options: Mapping[str, Mapping[str, Any]] | None = None,
    lost: dict[str, Observation] | None = None,
) -> DataFrame:
    """Run the steps on a table, as one plan that runs when its result is used.

    What a step must know beforehand runs at once: ``exact_median`` its passes, ``lemmatize`` the measuring of its
    dictionary, a step of the user's own its ``fit``. ``lost`` is filled, by step, with observations of how many
    values of each column could not be read and became null; they have their counts once the result was used.
    """
    require_dataframe(df)
    for name, stage in zip(steps, build_stages(steps, contract, options), strict=True):
        if lost is not None and hasattr(stage, "count_lost") and stage.rules:
            lost[name] = Observation(f"{name}-{uuid.uuid4().hex}")
            df = stage.count_lost(df, lost[name])
        if isinstance(stage, HandleNulls):
            df = stage.fill_in_one_plan(df)
        elif isinstance(stage, Estimator):
            df = stage.fit(df).transform(df)
        else:
            df = stage.transform(df)
    return df
