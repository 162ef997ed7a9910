"""Run the jobs of a file: ``python -m terrace jobs.yaml [layer ...]``."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from terrace.plans.jobs import LAYERS, load_jobs, run_layers


def main(arguments: list[str]) -> list[str]:
    if not arguments:
        raise SystemExit("usage: python -m terrace jobs.yaml [layer ...]")
    path, *layers = arguments
    spark = SparkSession.builder.appName("terrace").getOrCreate()
    return run_layers(spark, load_jobs(path), layers or tuple(LAYERS))


if __name__ == "__main__":
    print("\n".join(main(sys.argv[1:])))
