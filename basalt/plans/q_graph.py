"""Registered queries: edge-list graph jobs.

Stand-in edge list from lineitem: ``src = l_partkey % 2000``, ``dst = l_orderkey % 2000``,
``weight = l_quantity`` (every lineitem row is one edge; the modulo only maps keys to node
ids, no row is dropped).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basalt.operators import graph
from basalt.plans.registry import Tables, query
from basalt.session import scratch_path
from basalt.sinks.files import write_delimited
from basalt.sources.files import read_edges, read_edges_whitespace

EDGES_SQL = (
    "e AS (SELECT l_partkey % 2000 AS src, l_orderkey % 2000 AS dst, CAST(l_quantity AS BIGINT) AS weight FROM lineitem)"
)
PAIRS_SQL = (
    EDGES_SQL
    + ", p AS (SELECT least(src, dst) AS u, greatest(src, dst) AS v FROM e GROUP BY u, v "
    "HAVING (bool_or(src < dst) AND bool_or(src > dst)) OR bool_or(src = dst))"
)


def lineitem_edges(t: Tables):
    return t.lineitem.select(
        (F.col("l_partkey") % 2000).alias("src"),
        (F.col("l_orderkey") % 2000).alias("dst"),
        F.col("l_quantity").cast("long").alias("weight"),
    )


@query("out_degree", f"WITH {EDGES_SQL} SELECT src AS node, COUNT(*) AS out_degree FROM e GROUP BY src ORDER BY node")
def out_degree(spark, sf_dir):
    return graph.out_degree(lineitem_edges(Tables(spark, sf_dir)))


@query(
    "in_weight",
    f"WITH {EDGES_SQL} SELECT dst AS node, CAST(SUM(weight) AS BIGINT) AS in_weight FROM e GROUP BY dst ORDER BY node",
)
def in_weight(spark, sf_dir):
    return graph.in_weight(lineitem_edges(Tables(spark, sf_dir))).withColumn("in_weight", F.col("in_weight").cast("long"))


@query("reciprocal_pairs", f"WITH {PAIRS_SQL} SELECT u, v FROM p")
def reciprocal_pairs(spark, sf_dir):
    return graph.reciprocal_pairs(lineitem_edges(Tables(spark, sf_dir)))


@query(
    "reciprocal_adjacency",
    f"""
    WITH {PAIRS_SQL},
    b AS (SELECT u AS node, v AS neighbor FROM p UNION ALL SELECT v, u FROM p WHERE u <> v)
    SELECT node, ROW_NUMBER() OVER (PARTITION BY node ORDER BY neighbor) - 1 AS pos, neighbor FROM b
    """,
)
def reciprocal_adjacency(spark, sf_dir):
    return graph.reciprocal_adjacency(lineitem_edges(Tables(spark, sf_dir)), form="long")


@query(
    "reciprocal_chunks",
    f"""
    WITH {PAIRS_SQL},
    b AS (SELECT u AS node, v AS neighbor FROM p UNION ALL SELECT v, u FROM p WHERE u <> v),
    k AS (SELECT node, neighbor, (ROW_NUMBER() OVER (PARTITION BY node ORDER BY neighbor) - 1) // 2 AS chunk FROM b)
    SELECT node, chunk, '[' || string_agg(CAST(neighbor AS VARCHAR), ', ' ORDER BY neighbor) || ']' AS neighbors FROM k GROUP BY node, chunk
    """,
)
def reciprocal_chunks(spark, sf_dir):
    """Sorted neighbor lists in chunks of two, as text."""
    chunks = graph.reciprocal_adjacency(lineitem_edges(Tables(spark, sf_dir)), form="chunks", chunk=2)
    return chunks.withColumn("neighbors", F.concat(F.lit("["), F.array_join(F.col("neighbors").cast("array<string>"), ", "), F.lit("]")))


@query("edges_from_text", f"WITH {EDGES_SQL} SELECT src AS node, COUNT(*) AS out_degree FROM e GROUP BY src ORDER BY node")
def edges_from_text(spark, sf_dir):
    """Tab-separated edge text written from lineitem, read back with the edge-list source."""
    path = write_delimited(lineitem_edges(Tables(spark, sf_dir)), scratch_path(spark, "edges-tsv"), sep="\t")
    return graph.out_degree(read_edges(spark, path, sep="\t", weighted=True))


@query("edges_ws_from_text", f"WITH {PAIRS_SQL} SELECT u, v FROM p")
def edges_ws_from_text(spark, sf_dir):
    """Space-separated edge text (extra weight field ignored) read back, reciprocal pairs."""
    path = write_delimited(lineitem_edges(Tables(spark, sf_dir)), scratch_path(spark, "edges-ws"), sep=" ")
    return graph.reciprocal_pairs(read_edges_whitespace(spark, path))
