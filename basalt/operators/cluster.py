"""k-means with given or deterministic starting centroids.

Points are a DataFrame with an id and an ARRAY<DOUBLE> feature column. The k×d centroid
matrix is the only state and lives on the driver (its size is set by the parameters k and
d, not by the data). Each iteration is one Spark job:

* assignment is row-local: the centroids enter as a literal ARRAY<ARRAY<DOUBLE>> and
  ``transform``/``array_min`` pick the nearest one (no join, no shuffle);
* the update adds coordinates per cluster with numpy, batch by batch (``mapInArrow``): k×d
  partial sums per task are shuffled, and k×d means come back to the driver. Vectors with a
  missing or infinite element belong to no cluster and add nothing.

The new centroids are fed back as literals, so the lineage never grows across iterations.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.functions.batches import matrix
from basalt.functions.vectors import complete, lit_matrix, of_width, sq_dist, to_double_array

Matrix = list[list[float]]


def initial_centroids(k: int, d: int) -> Matrix:
    """Deterministic start: centroid i is (i+1, ..., i+1) in d dimensions."""
    return [[float(i + 1)] * d for i in range(k)]


def initial_centroids_df(spark: SparkSession, k: int, d: int) -> DataFrame:
    """The same start as a DataFrame ``(cluster_id, coords)``."""
    return spark.range(k).select(
        F.col("id").cast("int").alias("cluster_id"),
        F.array_repeat((F.col("id") + 1).cast("double"), d).alias("coords"),
    )


def first_points(points: DataFrame, k: int, id_col: str, feat: str) -> Matrix:
    """The k points with the smallest ids, as a starting centroid matrix (k rows to the driver)."""
    rows = points.select(id_col, to_double_array(feat).alias("f")).orderBy(id_col).limit(k).collect()
    return [list(r["f"]) for r in rows]


def _nearest(feat: Column, centroids: Matrix) -> Column:
    """struct(d2, cluster_id) of the nearest centroid; ties go to the lowest id."""
    cands = F.transform(lit_matrix(centroids), lambda c, i: F.struct(sq_dist(feat, c).alias("d2"), i.alias("cluster_id")))
    return F.array_min(cands)


def assign(points: DataFrame, centroids: Matrix, feat: str = "features", name: str = "cluster_id") -> DataFrame:
    """Add the nearest centroid's index ``name`` and the squared distance ``d2``; a vector
    of another width than the centroids fails the job. Both are NULL for a vector that is NULL or
    has a NULL, NaN or infinite element."""
    x = of_width(feat, len(centroids[0]))
    best = F.when(complete(x), _nearest(x, centroids))
    return points.withColumn("_best", best).withColumn(name, F.col("_best.cluster_id")).withColumn(
        "d2", F.col("_best.d2")
    ).drop("_best")


def distance_matrix(points: DataFrame, centroids: Matrix, id_col: str, feat: str = "features") -> DataFrame:
    """Long form ``(id, cluster_id, distance)``: Euclidean distance to every centroid.

    Generated row-locally from the literal centroid matrix (k rows per point, no join). Vectors
    that are NULL or have a NULL, NaN or infinite element have no rows.
    """
    points = points.where(complete(to_double_array(feat)))
    f = of_width(feat, len(centroids[0]))
    per = F.transform(lit_matrix(centroids), lambda c, i: F.struct(i.alias("cluster_id"), F.sqrt(sq_dist(f, c)).alias("distance")))
    return points.select(id_col, F.explode(per).alias("s")).select(id_col, "s.cluster_id", "s.distance")


def centroid_sums(assigned: DataFrame, feat: str = "features", cluster: str = "cluster_id") -> DataFrame:
    """Per (cluster, coordinate j): mean and count, long form. At most k×d rows.

    Rows without a cluster and vectors with a NULL, NaN or infinite element take no part; they
    are told apart inside the batch, so no other row is lost with them. :func:`left_out` counts them.
    """
    schema = T.StructType([T.StructField("c", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("s", T.DoubleType()), T.StructField("m", T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = {}, {}
        for batch in batches:
            x, whole = matrix(batch.column(1))
            clusters = batch.column(0).to_numpy(zero_copy_only=False)[whole].astype(np.int64)
            for k in np.unique(clusters).tolist():
                part = x[whole][clusters == k]
                sums[k] = sums.get(k, 0.0) + part.sum(axis=0)
                counts[k] = counts.get(k, 0) + len(part)
        for k, total in sums.items():
            d = len(total)
            yield pa.record_batch({"c": np.full(d, k, np.int32), "j": np.arange(d, dtype=np.int32), "s": total, "m": np.full(d, counts[k], np.int64)})

    rows = assigned.select(F.col(cluster).cast("int").alias("c"), to_double_array(feat).alias("x")).where(F.col("c").isNotNull() & F.col("x").isNotNull())
    partial = rows.mapInArrow(add, schema)
    return partial.groupBy(F.col("c").alias(cluster), "j").agg((F.sum("s") / F.sum("m")).alias("coord"), F.sum("m").alias("n"))


def left_out(points: DataFrame, feat: str = "features") -> DataFrame:
    """One row (rows, left_out): how many vectors take no part, being NULL or not whole."""
    return points.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~complete(to_double_array(feat))).alias("left_out"))


def update(assigned: DataFrame, k: int, d: int, feat: str = "features", cluster: str = "cluster_id") -> tuple[dict[int, list[float]], dict[int, int]]:
    """New centroid per non-empty cluster (cluster → coords) and the cluster sizes."""
    rows = centroid_sums(assigned, feat, cluster).collect()
    coords: dict[int, list[float]] = {}
    sizes: dict[int, int] = {}
    for r in rows:
        c = r[cluster]
        coords.setdefault(c, [0.0] * d)[r["j"]] = r["coord"]
        sizes[c] = r["n"]
    return coords, sizes


@dataclass
class KMeansResult:
    centroids: Matrix
    history: list[tuple[int, int, int]] = field(default_factory=list)  # (iteration, unconverged, k)
    assignments: DataFrame | None = None
    converged: bool = False
    # (iteration, cluster_id before renumbering, new coords, shift) for every updated cluster
    centroid_history: list[tuple[int, int, list[float], float]] = field(default_factory=list)


def kmeans(
    points: DataFrame,
    centroids: Matrix,
    feat: str = "features",
    tol: float = 0.1,
    max_iter: int | None = None,
    empty: str = "drop",
    id_col: str | None = None,
    assignments_path: str | None = None,
    partial: bool = False,
) -> KMeansResult:
    """Lloyd iterations until every centroid moves at most ``tol`` (Euclidean).

    ``max_iter`` bounds the iterations: reaching it raises, unless ``partial`` asks for what was
    found so far. ``empty="drop"``: a cluster that receives no point disappears and the
    remaining ids are renumbered in order; ``empty="keep"``: it keeps its previous centroid.
    The returned assignments are those of the last iteration (against the centroids it
    started from), as a plan over ``points`` that does not depend on anything cached.
    ``assignments_path`` (with ``id_col``) additionally writes every iteration's
    ``(id, cluster_id, iteration)``, each to its own replaced folder ``iteration=<i>``; it is
    opt-in because it writes all points once per iteration.
    """
    if empty not in ("drop", "keep"):
        raise ValueError("empty must be 'drop' or 'keep'")
    if assignments_path is not None and id_col is None:
        raise ValueError("assignments_path needs id_col")
    d = len(centroids[0])
    pts = points.withColumn(feat, to_double_array(feat)).persist(StorageLevel.MEMORY_AND_DISK)
    current = [list(map(float, c)) for c in centroids]
    result = KMeansResult(centroids=current)
    try:
        it, last = 0, None
        while not result.converged:
            if max_iter is not None and it == max_iter:
                if partial:
                    break
                raise RuntimeError(f"no convergence within {max_iter} iterations")
            it += 1
            started = current
            assigned = assign(pts, started, feat)
            new, _sizes = update(assigned, len(started), d, feat)
            unconverged, current = 0, []
            for cid, old in enumerate(started):
                if cid in new:
                    shift = math.sqrt(sum((a - b) ** 2 for a, b in zip(old, new[cid])))
                    unconverged += shift > tol
                    current.append(new[cid])
                    result.centroid_history.append((it, cid, list(new[cid]), shift))
                elif empty == "keep":
                    current.append(old)
            result.history.append((it, unconverged, len(current)))
            if assignments_path is not None:
                assigned.select(id_col, "cluster_id").write.mode("overwrite").parquet(f"{assignments_path}/iteration={it}")
            last = started
            result.converged = unconverged == 0
    finally:
        pts.unpersist()
    result.centroids = current
    if last is not None:
        result.assignments = assign(points.withColumn(feat, to_double_array(feat)), last, feat)
    return result


def centroids_frame(spark: SparkSession, centroids: Matrix) -> DataFrame:
    """Long form ``(cluster_id, j, coord)`` of a centroid matrix."""
    rows = [(i, j, float(v)) for i, c in enumerate(centroids) for j, v in enumerate(c)]
    return spark.createDataFrame(rows, "cluster_id INT, j INT, coord DOUBLE")


def centroid_history_frame(spark: SparkSession, result: KMeansResult) -> DataFrame:
    """``(iteration, cluster_id, coords, shift)``: every centroid update of a run."""
    return spark.createDataFrame(result.centroid_history, "iteration INT, cluster_id INT, coords ARRAY<DOUBLE>, shift DOUBLE")
