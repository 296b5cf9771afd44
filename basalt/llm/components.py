"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.session import scratch_path


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    ``edges``: columns ``a`` and ``b`` of an orderable type, any direction, repeats and
    self-links allowed. Each step groups by node with map-side minima and writes its edges, so
    no neighbourhood is gathered in one task and lineage stays short; the number of steps
    grows with the logarithm of the number of nodes.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, "components")
    current = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current.write.parquet(f"{path}/0")
    current, step = spark.read.parquet(f"{path}/0"), 0
    while True:
        # Done once every node has one edge down at most and nothing leads to such a node.
        sides = current.select(F.col("u").alias("node"), F.lit(1).alias("side")).unionByName(current.select(F.col("v").alias("node"), F.lit(2).alias("side")))
        if sides.groupBy("node").agg(F.sum(F.when(F.col("side") == 1, 1).otherwise(0)).alias("down"), F.max("side").alias("side")).filter("down > 1 or (down = 1 and side = 2)").isEmpty():
            break
        step += 1
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large.write.parquet(f"{path}/{step}-large")
        large = spark.read.parquet(f"{path}/{step}-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct().write.parquet(f"{path}/{step}")
        current = spark.read.parquet(f"{path}/{step}")
    roots = current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
