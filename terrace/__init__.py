"""Layered tables on Spark: ingest new files, clean by contract, build features."""

from terrace.contract import load_contract, load_schema, schema_from_dict, validate_contract
from terrace.plans.cleaning import build_pipeline, clean, register_step
from terrace.plans.jobs import Bronze, Gold, Silver, compact_bronze, run_bronze, run_gold, run_layers, run_silver
from terrace.sources import overwrite_table, read_new_files, read_table, register, register_source
from terrace.streaming import append_new

__all__ = [
    "Bronze",
    "Gold",
    "Silver",
    "append_new",
    "build_pipeline",
    "clean",
    "compact_bronze",
    "load_contract",
    "load_schema",
    "overwrite_table",
    "read_new_files",
    "read_table",
    "register",
    "register_source",
    "register_step",
    "run_bronze",
    "run_gold",
    "run_layers",
    "run_silver",
    "schema_from_dict",
    "validate_contract",
]
