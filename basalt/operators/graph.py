"""Edge-list graph jobs: out-degree, incoming weight, reciprocal pairs and adjacency.

Edges are a DataFrame ``(src, dst[, weight])``. Each job is one grouped aggregate (partial
aggregation before the shuffle, so a hub node costs one partial row per task), followed
by an ordered output where the reference sorts by node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.operators.ordering import rank_within


def out_degree(edges: DataFrame, src: str = "src", name: str = "out_degree") -> DataFrame:
    """Edges leaving each node (duplicates counted; nodes without out-edges absent)."""
    return (
        edges.where(F.col(src).isNotNull())
        .groupBy(F.col(src).alias("node"))
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy("node")
    )


def in_weight(edges: DataFrame, dst: str = "dst", weight: str = "weight", name: str = "in_weight") -> DataFrame:
    """Sum of the weights of edges entering each node (duplicates summed).

    Whole numbers add up to a DECIMAL(38, 0), as a hub's sum may pass 64 bits.
    """
    whole = dict(edges.dtypes)[weight] in ("tinyint", "smallint", "int", "bigint")
    total = F.sum(F.col(weight).cast("decimal(19,0)")).cast("decimal(38,0)") if whole else F.sum(weight)
    return edges.where(F.col(dst).isNotNull()).groupBy(F.col(dst).alias("node")).agg(total.alias(name)).orderBy("node")


def reciprocal_pairs(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Unordered pairs ``u <= v`` with an edge u→v and an edge v→u; a self-loop qualifies.

    One shuffle: group on (least, greatest) and keep groups that saw both directions.
    Duplicate edges collapse.
    """
    s, d = F.col(src), F.col(dst)
    return (
        edges.where(s.isNotNull() & d.isNotNull())
        .groupBy(F.least(s, d).alias("u"), F.greatest(s, d).alias("v"))
        .agg(
            F.bool_or(s < d).alias("_fwd"),
            F.bool_or(s > d).alias("_bwd"),
            F.bool_or(s == d).alias("_self"),
        )
        .where((F.col("_fwd") & F.col("_bwd")) | F.col("_self"))
        .select("u", "v")
    )


def reciprocal_adjacency(
    edges: DataFrame, src: str = "src", dst: str = "dst", form: str = "long", with_position: bool = True, chunk: int = 1000
) -> DataFrame:
    """Every node with the nodes it has a two-way edge to, in ascending order.

    ``form="long"`` (default, scales with hub nodes): rows ``(node, neighbor[, pos])``
    where ``pos`` is the neighbor's 0-based place in the node's sorted list, computed by a
    distributed sort rather than a per-node window.
    ``form="chunks"``: ``(node, chunk, neighbors ARRAY)``, a node's sorted list cut into pieces of at most
    ``chunk`` neighbors, so no row and no group grows with a hub.
    ``form="list"``: ``(node, neighbors ARRAY)``, one row per node — only for graphs whose
    degree is known to be bounded, since a whole list lives in one row.
    """
    pairs = reciprocal_pairs(edges, src, dst)
    both = pairs.select(F.col("u").alias("node"), F.col("v").alias("neighbor")).unionByName(
        pairs.where(F.col("u") != F.col("v")).select(F.col("v").alias("node"), F.col("u").alias("neighbor"))
    )
    if form == "list":
        return both.groupBy("node").agg(F.sort_array(F.collect_list("neighbor")).alias("neighbors")).orderBy("node")
    if form == "chunks":
        placed = rank_within(both, ["node"], ["neighbor"], name="pos").withColumn("chunk", F.floor(F.col("pos") / chunk))
        return placed.groupBy("node", "chunk").agg(F.sort_array(F.collect_list("neighbor")).alias("neighbors"))
    if form != "long":
        raise ValueError("form must be 'long', 'chunks' or 'list'")
    if not with_position:
        return both.orderBy("node", "neighbor")
    return rank_within(both, ["node"], ["neighbor"], name="pos").select("node", "pos", "neighbor")
