"""Definition files: the column list of a raw table and the cleaning contract."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from numbers import Number
from typing import Any

import yaml
from pyspark.sql.types import StringType, StructField, StructType

HOW = ("any", "all")
LEARNED = ("mean", "median")


def schema_from_dict(definition: Mapping[str, Any]) -> StructType:
    """``{"columns": [{"name": ...}, ...]}`` to a schema of nullable strings.

    Raw tables hold text only, so that a malformed value lands instead of failing the load; any
    type in the definition is ignored.
    """
    return StructType([StructField(c["name"], StringType(), True) for c in definition["columns"]])


def load_schema(path: str) -> StructType:
    with open(path, encoding="utf-8") as f:
        return schema_from_dict(json.load(f))


def load_contract(path: str) -> dict[str, Any]:
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def section(contract: Mapping[str, Any], name: str) -> Any:
    """A section of the contract; one that is absent or left empty is None."""
    return contract.get(name) or None


def as_list(value: Any) -> list:
    """None, one item or several, as a list."""
    if value is None:
        return []
    return list(value) if isinstance(value, Sequence) and not isinstance(value, str) else [value]


def ordering(entry: str) -> tuple[str, bool]:
    """An ``order_by`` entry, ``"col"``, ``"col asc"`` or ``"col desc"``, as ``(col, descending)``."""
    name, _, direction = entry.rpartition(" ")
    return (name, direction == "desc") if direction in ("asc", "desc") and name else (entry, False)


def fill_rule(strategy: Any) -> tuple[str, Any]:
    """A ``null_handling`` entry as ``(kind, constant)``.

    ``mean`` and ``median`` are learnt; any number or text is a constant. ``{"value": x}`` is the
    constant ``x`` even when it is one of those two words.
    """
    if isinstance(strategy, Mapping) and set(strategy) == {"value"}:
        kind, constant = "constant", strategy["value"]
    elif isinstance(strategy, str) and strategy in LEARNED:
        kind, constant = strategy, None
    else:
        kind, constant = "constant", strategy
    if kind == "constant" and not isinstance(constant, (Number, str)):
        raise ValueError(f"'{strategy}' is not a way to fill nulls: use mean, median, a number or text")
    return kind, constant


def validate_contract(contract: Mapping[str, Any], columns: Iterable[str] | None = None) -> dict[str, Any]:
    """Check the sections known here; all errors come in one ``ValueError``.

    ``columns`` are the columns the steps will see; without them only the shape is checked.
    """
    known = None if columns is None else set(columns)
    errors: list[str] = []

    def need(where: str, names: Iterable[str | None]) -> None:
        for n in names:
            if not isinstance(n, str):
                errors.append(f"{where}: '{n}' is not a column name")
            elif known is not None and n not in known:
                errors.append(f"{where}: column '{n}' does not exist")

    def mapping(name: str) -> Mapping[str, Any]:
        rules = section(contract, name) or {}
        if not isinstance(rules, Mapping):
            errors.append(f"{name}: must be a map")
            return {}
        return rules

    dedup = mapping("remove_duplicates")
    need("remove_duplicates", as_list(dedup.get("subset_cols")))
    need("remove_duplicates", [ordering(str(o))[0] for o in as_list(dedup.get("order_by"))])

    drop = mapping("remove_nulls")
    need("remove_nulls", as_list(drop.get("subset_cols")))
    if (drop.get("how") or "any") not in HOW:
        errors.append(f"remove_nulls: how must be any or all, not '{drop['how']}'")

    need("convert_types", mapping("convert_types"))

    fills = mapping("null_handling")
    need("null_handling", fills)
    for name, strategy in fills.items():
        try:
            fill_rule(strategy)
        except ValueError as e:
            errors.append(f"null_handling: column '{name}': {e}")

    need("normalize_text", as_list(section(contract, "normalize_text")))

    for rule in as_list(section(contract, "normalize_timestamp")):
        if isinstance(rule, Mapping):
            need("normalize_timestamp", [rule.get("input_col")])
        else:
            errors.append("normalize_timestamp: must be a map with input_col and format")

    lemmas = mapping("lemmatize")
    if lemmas:
        need("lemmatize", [lemmas.get("key"), lemmas.get("text")])
        if not isinstance(lemmas.get("dictionary"), str):
            errors.append("lemmatize: dictionary must name a table")

    if errors:
        raise ValueError("; ".join(errors))
    return dict(contract)
