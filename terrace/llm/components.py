"""Connected components of links, by stars that are contracted until they are all there is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(links: DataFrame, write: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``node`` and ``component``, the smallest node linked to it, of every node with a link (``a``, ``b``).

    Each step points every node's neighbours to the smallest one among them, first the larger neighbours, then
    the smaller ones; the number of steps goes with the logarithm of the longest path, and no task sees more
    than rows of links. ``write`` keeps a step's links in a table and gives them back.
    """

    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    def marked(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = write(edges, "links")
    before = marked(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = smallest(both).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = write(large.where("u <> v").distinct(), "stars")
        least = smallest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        edges = write(small.where("u <> v").distinct(), "links")
        if (after := marked(edges)) == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
