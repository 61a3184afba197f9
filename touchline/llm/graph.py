"""Connected components by alternating star contraction, each round a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, scratch


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on an edge (a, b): the smallest node reachable.

    Every round joins each node's edges to the least of its neighbours; a hub
    with very many edges is combined before the shuffle (its minimum) and its
    edge rows are split by AQE's skew join.  The rounds grow with the logarithm
    of the longest path; only their row count and checksum reach the driver."""
    spark = edges.sparkSession
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    path, before = _save(pairs), None
    while True:
        pairs = spark.read.schema("a long, b long").parquet(path)
        mark = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == before:
            break
        before = mark
        if not mark[0]:
            break
        large = _save(_star(pairs, large=True))
        small = _save(_star(spark.read.schema("a long, b long").parquet(large), large=False))
        discard(spark, large)
        discard(spark, path)
        path = small
    # at the end every edge joins a node to its component's smallest
    return pairs.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        pairs.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def _save(df: DataFrame) -> str:
    path = scratch(df.sparkSession, "edges")
    df.write.parquet(path)
    return path


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Large star: every node joins its greater neighbours to the least of its neighbourhood.
    Small star: every node joins itself and its lesser neighbours to the least of these."""
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    moved = joined.filter("v > u") if large else joined
    out = moved.select(F.col("m").alias("a"), F.col("v").alias("b"))
    if not large:
        out = out.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
