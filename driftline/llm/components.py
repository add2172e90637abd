"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, label`` for every node with an edge to another; the label is the smallest node reachable.

    Each step moves every node's neighbours to the smallest one it knows; the number of steps grows with the logarithm of
    the longest path. Minima are combined before the shuffle, so a node with a third of all edges is no hot group there, and
    the joins are plain inner joins, which adaptive execution splits. A step ends with a checkpoint.
    """
    shared_dir(edges.sparkSession)
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct().checkpoint()
    seen = None
    while (print_ := _fingerprint(now)) != seen:
        seen = print_
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        now = small.where("u <> v").distinct().checkpoint()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select("v", "v").distinct())
