"""Registered queries: k-means on the embeddings table.

Start: the K vectors with the smallest ``vec_id`` (the deterministic (i+1, ..., i+1)
start would put every short vector into cluster 0, so it is exercised in the unit tests).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basalt.operators import cluster, many_centroids
from basalt.plans.registry import Tables, query
from basalt.session import scratch_path

K = 10
TOL = 0.1

_START = f"""
c AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster_id,
             CAST(embedding AS DOUBLE[]) AS coords
      FROM embeddings ORDER BY vec_id LIMIT {K}),
dm AS (SELECT e.vec_id, c.cluster_id, list_distance(CAST(e.embedding AS DOUBLE[]), c.coords) AS distance,
              CAST(e.embedding AS DOUBLE[]) AS f
       FROM embeddings e, c),
a AS (SELECT vec_id, cluster_id, f FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY distance, cluster_id) AS rn FROM dm) WHERE rn = 1)
"""


def _start(t: Tables):
    emb = t.embeddings
    return emb, cluster.first_points(emb, K, "vec_id", "embedding")


@query("distance_matrix", f"WITH {_START} SELECT vec_id, cluster_id, ROUND(distance, 6) AS distance FROM dm")
def distance_matrix(spark, sf_dir):
    emb, start = _start(Tables(spark, sf_dir))
    dm = cluster.distance_matrix(emb, start, "vec_id", "embedding")
    return dm.withColumn("distance", F.round("distance", 6))


@query("kmeans_assign", f"WITH {_START} SELECT vec_id, cluster_id FROM a")
def kmeans_assign(spark, sf_dir):
    emb, start = _start(Tables(spark, sf_dir))
    return cluster.assign(emb, start, "embedding").select("vec_id", "cluster_id")


@query(
    "kmeans_step",
    f"""
    WITH {_START},
    x AS (SELECT cluster_id, UNNEST(range(len(f))) AS j, UNNEST(f) AS v FROM a)
    SELECT cluster_id, CAST(j AS INTEGER) AS j, ROUND(AVG(v), 6) AS coord, COUNT(*) AS n FROM x GROUP BY cluster_id, j
    """,
)
def kmeans_step(spark, sf_dir):
    emb, start = _start(Tables(spark, sf_dir))
    sums = cluster.centroid_sums(cluster.assign(emb, start, "embedding"), "embedding")
    return sums.withColumn("coord", F.round("coord", 6))


def _holed(emb):
    """The embeddings with one element NaN in some rows and NULL in others."""
    x, at = F.col("embedding").cast("array<double>"), F.pmod("vec_id", F.lit(64)).cast("int")
    nan, null = F.col("vec_id") % 17 == 3, F.col("vec_id") % 19 == 4
    holed = F.transform(x, lambda v, i: F.when((i == at) & nan, F.lit(float("nan"))).when((i == at) & null, F.lit(None)).otherwise(v))
    return emb.withColumn("embedding", holed)


@query(
    "kmeans_step_missing",
    f"""
    WITH {_START},
    x AS (SELECT cluster_id, UNNEST(range(len(f))) AS j, UNNEST(f) AS v FROM a WHERE vec_id % 17 <> 3 AND vec_id % 19 <> 4)
    SELECT cluster_id, CAST(j AS INTEGER) AS j, ROUND(AVG(v), 6) AS coord, COUNT(*) AS n FROM x GROUP BY cluster_id, j
    """,
)
def kmeans_step_missing(spark, sf_dir):
    """A centroid update in which vectors with a missing element take no part."""
    emb, start = _start(Tables(spark, sf_dir))
    sums = cluster.centroid_sums(cluster.assign(_holed(emb), start, "embedding"), "embedding")
    return sums.withColumn("coord", F.round("coord", 6))


@query("points_left_out", "SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE vec_id % 17 = 3 OR vec_id % 19 = 4) AS left_out FROM embeddings")
def points_left_out(spark, sf_dir):
    return cluster.left_out(_holed(Tables(spark, sf_dir).embeddings), "embedding")


@query(
    "kmeans_assign_many",
    """
    WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
    c AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster_id, f FROM e WHERE vec_id % 5 = 0),
    d AS (SELECT e.vec_id, c.cluster_id, row_number() OVER (PARTITION BY e.vec_id ORDER BY list_sum(list_transform(list_zip(e.f, c.f), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.cluster_id) AS rn FROM e, c)
    SELECT vec_id, cluster_id FROM d WHERE rn = 1
    """,
)
def kmeans_assign_many(spark, sf_dir):
    """Nearest of many centroids: every fifth vector is one, held in a broadcast table."""
    emb = Tables(spark, sf_dir).embeddings
    centroids = [r[0] for r in emb.where("vec_id % 5 = 0").orderBy("vec_id").select(F.col("embedding").cast("array<double>")).collect()]
    return many_centroids.assign_many(emb.select("vec_id", "embedding"), centroids, "embedding").select("vec_id", "cluster_id")


# Lloyd iterations as a recursive query: each step keeps the clusters that got points,
# renumbered, with the id each had before and how far it moved; it ends with the first step in
# which no cluster moved further than the tolerance.
_LLOYD = f"""
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
t(it, cluster_id, was, coords, shift, moved) AS (
    SELECT 0, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER), -1, f, CAST(0 AS DOUBLE), CAST(1 AS BIGINT)
    FROM (SELECT * FROM e ORDER BY vec_id LIMIT {K})
    UNION ALL
    SELECT it + 1, CAST(row_number() OVER (ORDER BY cluster_id) - 1 AS INTEGER), cluster_id, new, list_distance(old, new),
           CAST(SUM(CAST(list_distance(old, new) > {TOL} AS INTEGER)) OVER () AS BIGINT)
    FROM (
        SELECT it, cluster_id, old, list(m ORDER BY j) AS new FROM (
            SELECT it, cluster_id, old, j, AVG(v) AS m FROM (
                SELECT it, cluster_id, coords AS old, unnest(range(len(f))) AS j, unnest(f) AS v FROM (
                    SELECT t.it, t.cluster_id, t.coords, e.f,
                           row_number() OVER (PARTITION BY e.vec_id ORDER BY list_distance(e.f, t.coords), t.cluster_id) AS rn
                    FROM e, t WHERE t.moved > 0)
                WHERE rn = 1)
            GROUP BY it, cluster_id, old, j)
        GROUP BY it, cluster_id, old)),
last AS (SELECT MAX(it) AS n FROM t),
of AS (
    SELECT it + 1 AS iteration, vec_id, cluster_id FROM (
        SELECT t.it, e.vec_id, t.cluster_id, row_number() OVER (PARTITION BY t.it, e.vec_id ORDER BY list_distance(e.f, t.coords), t.cluster_id) AS rn
        FROM e, t, last WHERE t.it < last.n)
    WHERE rn = 1)
"""


def _fit(spark, sf_dir, **kw):
    emb, start = _start(Tables(spark, sf_dir))
    return cluster.kmeans(emb.select("vec_id", "embedding"), start, feat="embedding", tol=TOL, **kw)


@query("kmeans_fit", _LLOYD + "SELECT vec_id, cluster_id FROM of, last WHERE iteration = last.n")
def kmeans_fit(spark, sf_dir):
    """Final assignment of every vector after convergence."""
    return _fit(spark, sf_dir).assignments.select("vec_id", "cluster_id")


@query(
    "kmeans_centroids",
    _LLOYD + "SELECT cluster_id, CAST(j AS INTEGER) AS j, ROUND(v, 6) AS coord FROM "
    "(SELECT cluster_id, unnest(range(len(coords))) AS j, unnest(coords) AS v FROM t, last WHERE it = last.n)",
)
def kmeans_centroids(spark, sf_dir):
    """Final centroids, long form (cluster_id, j, coord)."""
    return cluster.centroids_frame(spark, _fit(spark, sf_dir).centroids).withColumn("coord", F.round("coord", 6))


@query(
    "kmeans_history",
    _LLOYD + "SELECT it AS iteration, CAST(any_value(moved) AS INTEGER) AS n_unconverged, CAST(COUNT(*) AS INTEGER) AS n_clusters FROM t WHERE it > 0 GROUP BY it",
)
def kmeans_history(spark, sf_dir):
    """Unconverged clusters per iteration."""
    h = _fit(spark, sf_dir).history
    return spark.createDataFrame(h, "iteration INT, n_unconverged INT, n_clusters INT")


@query(
    "kmeans_centroid_history",
    _LLOYD + "SELECT iteration, cluster_id, CAST(j AS INTEGER) AS j, ROUND(v, 6) AS coord, ROUND(shift, 6) AS shift FROM "
    "(SELECT it AS iteration, was AS cluster_id, shift, unnest(range(len(coords))) AS j, unnest(coords) AS v FROM t WHERE it > 0)",
)
def kmeans_centroid_history(spark, sf_dir):
    """Every centroid update of the run, one row per coordinate."""
    h = cluster.centroid_history_frame(spark, _fit(spark, sf_dir))
    long = h.select("iteration", "cluster_id", F.round("shift", 6).alias("shift"), F.posexplode("coords").alias("j", "coord"))
    return long.withColumn("coord", F.round("coord", 6))


@query("kmeans_assignment_history", _LLOYD + "SELECT vec_id, cluster_id, iteration FROM of")
def kmeans_assignment_history(spark, sf_dir):
    """The assignments of every iteration, read back from the folder the run wrote."""
    path = scratch_path(spark, "kmeans-assignments")
    _fit(spark, sf_dir, id_col="vec_id", assignments_path=path)
    return spark.read.parquet(path).select("vec_id", "cluster_id", "iteration")


@query(
    "kmeans_assign_default_start",
    f"""
    WITH c AS (SELECT CAST(i AS INTEGER) AS cluster_id FROM range({K}) t(i)),
    p AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda v: v + label) AS f FROM embeddings),
    dm AS (SELECT p.vec_id, c.cluster_id,
                  list_distance(p.f, list_transform(range(len(p.f)), lambda j: CAST(c.cluster_id + 1 AS DOUBLE))) AS distance
           FROM p, c)
    SELECT vec_id, cluster_id FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY distance, cluster_id) AS rn FROM dm) WHERE rn = 1
    """,
)
def kmeans_assign_default_start(spark, sf_dir):
    """Nearest deterministic start centroid (i+1, ..., i+1); the vectors are moved by their
    label along every axis, so that they lie among all the centroids."""
    emb = Tables(spark, sf_dir).embeddings
    moved = emb.select("vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda v: v + F.col("label")).alias("f"))
    d = emb.select(F.size("embedding")).first()[0]
    return cluster.assign(moved, cluster.initial_centroids(K, d), "f").select("vec_id", "cluster_id")
