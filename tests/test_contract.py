import json

import pytest
from pyspark.sql.types import StringType

from terrace import load_contract, load_schema, schema_from_dict, validate_contract
from terrace.contract import fill_rule, ordering

GAUGES = ["gauge", "river", "keeper", "level", "read_at"]

CONTRACT = """
remove_duplicates:
  subset_cols: [gauge, read_at]
  order_by: [level desc]
remove_nulls:
  subset_cols: gauge
  how: all
convert_types: {gauge: bigint, level: "decimal(9,2)"}
null_handling: {level: median, keeper: {value: mean}}
normalize_text: river
normalize_timestamp:
  - {input_col: read_at, format: dd.MM.yyyy HH:mm}
"""


def test_schema_holds_nullable_strings_only(tmp_path):
    path = tmp_path / "schema.json"
    path.write_text(json.dumps({"columns": [{"name": "id", "type": "integer"}, {"name": "a b"}]}))
    schema = load_schema(str(path))
    assert schema == schema_from_dict({"columns": [{"name": "id"}, {"name": "a b"}]})
    assert schema.names == ["id", "a b"]
    assert all(f.dataType == StringType() and f.nullable for f in schema)


def test_contract_file(tmp_path):
    path = tmp_path / "contract.yaml"
    path.write_text(CONTRACT)
    contract = load_contract(str(path))
    assert contract["remove_duplicates"] == {"subset_cols": ["gauge", "read_at"], "order_by": ["level desc"]}
    assert validate_contract(contract, GAUGES) == contract


def test_empty_contract_and_empty_sections_are_fine(tmp_path):
    path = tmp_path / "contract.yaml"
    path.write_text("")
    assert load_contract(str(path)) == {}
    empty = dict.fromkeys(
        ["remove_duplicates", "remove_nulls", "convert_types", "null_handling", "normalize_text", "normalize_timestamp"]
    )
    validate_contract(empty, ["a"])


def test_all_errors_come_together():
    bad = {
        "remove_duplicates": {"subset_cols": ["nope"], "order_by": ["gone desc"]},
        "remove_nulls": {"how": "some"},
        "convert_types": {"missing": "int"},
        "null_handling": {"a": ["mean"]},
        "normalize_text": "absent",
        "normalize_timestamp": {"format": "yyyy"},
        "lemmatize": {"key": "lost", "text": "a", "dictionary": 1},
    }
    with pytest.raises(ValueError) as e:
        validate_contract(bad, ["a"])
    for word in ("nope", "gone", "some", "missing", "['mean']", "absent", "None", "lost", "dictionary"):
        assert word in str(e.value)


@pytest.mark.parametrize(
    ("strategy", "rule"),
    [
        ("mean", ("mean", None)),
        ("median", ("median", None)),
        ("other", ("constant", "other")),
        (0, ("constant", 0)),
        (True, ("constant", True)),
        ({"value": "mean"}, ("constant", "mean")),
    ],
)
def test_fill_rules(strategy, rule):
    assert fill_rule(strategy) == rule


@pytest.mark.parametrize("strategy", [None, ["mean"], {"other": 1}, {"value": None}])
def test_unknown_fill_rules(strategy):
    with pytest.raises(ValueError):
        fill_rule(strategy)


def test_order_entries():
    assert ordering("a") == ("a", False)
    assert ordering("a desc") == ("a", True)
    assert ordering("a b asc") == ("a b", False)
    assert ordering("a b") == ("a b", False)
