"""k-means with many centroids: a broadcast centroid table, block distances by matrix product, and
triangle-inequality bounds that points carry from one iteration to the next.

The plan names a broadcast, not the numbers, so its size does not depend on k or d. Squared
distances |x|^2 - 2 x.c + |c|^2 of a batch and a block of centroids are one matrix product; those
within rounding of the least are computed again, coordinate by coordinate as
:func:`basalt.operators.cluster.assign` does, so both give the same cluster (ties to the lowest id).

A point carries an upper bound on the distance to its centroid and a lower bound on that to any
other. After an update the first grows by the shift of its centroid, the second shrinks by the
largest shift; as long as they stay apart the point needs no distance at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.functions.batches import matrix
from basalt.functions.vectors import of_width, to_double_array
from basalt.operators.cluster import KMeansResult
from basalt.session import scratch_path

MAX_BYTES = 256 << 20  # of a centroid table that is broadcast
BLOCK = 512  # centroids in one matrix product
ROWS = 2048  # points in one


def centroid_table(spark: SparkSession, centroids: np.ndarray, max_bytes: int = MAX_BYTES) -> list[Broadcast]:
    """The table as broadcasts of at most ``max_bytes``; a larger table is several, read one by one."""
    rows = max(1, max_bytes // (8 * max(1, centroids.shape[1])))
    return [spark.sparkContext.broadcast((a, np.ascontiguousarray(centroids[a : a + rows], float))) for a in range(0, len(centroids), rows)]


def _in_order(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows, summed from the first coordinate to the last."""
    return np.add.accumulate((x - c) ** 2, axis=1)[:, -1]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, squared distance, distance to the second nearest) for each row of x."""
    n, d = x.shape
    best, at, second = np.full(n, np.inf), np.zeros(n, np.int64), np.full(n, np.inf)
    xx = np.einsum("ij,ij->i", x, x)
    for a in range(0, len(centroids), BLOCK):
        c = centroids[a : a + BLOCK]
        cc = np.einsum("ij,ij->i", c, c)
        near = xx[:, None] - 2 * (x @ c.T) + cc
        slack = 8 * (d + 2) * np.finfo(float).eps * (xx[:, None] + cc)
        # A centroid counts again if rounding might hide that it is the nearest.
        row, col = np.nonzero(near - slack <= (near + slack).min(axis=1)[:, None])
        exact = _in_order(x[row], c[col])
        order = np.lexsort((col, exact, row))
        first = order[np.searchsorted(row[order], np.arange(n))]
        low = np.maximum(near - slack, 0)
        low[np.arange(n), col[first]] = np.inf
        rest = low.min(axis=1) if c.shape[0] > 1 else np.full(n, np.inf)
        wins = exact[first] < best
        second = np.minimum(second, np.where(wins, np.minimum(best, rest), np.minimum(exact[first], rest)))
        at = np.where(wins, a + col[first], at)
        best = np.where(wins, exact[first], best)
    return at, best, np.sqrt(second)


def assign_many(points: DataFrame, centroids: np.ndarray, feat: str = "features", name: str = "cluster_id", max_bytes: int = MAX_BYTES) -> DataFrame:
    """Add the nearest centroid's index ``name`` and the squared distance ``d2``, as :func:`cluster.assign`
    does, without a literal of the centroids in the plan.

    Both are NULL for a vector that is NULL or has a NULL, NaN or infinite element; a vector of
    another width than the centroids fails the job.
    """
    centroids = np.asarray(centroids, float)
    table = centroid_table(points.sparkSession, centroids, max_bytes)
    d, there = centroids.shape[1], points.columns
    staged = points.withColumn("__x", F.when(F.col(feat).isNotNull(), of_width(feat, d)))
    schema = T.StructType([*points.schema.fields, T.StructField(name, T.IntegerType()), T.StructField("d2", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                some = batch.slice(a, ROWS)
                x, whole = matrix(some.column(some.num_columns - 1))
                best, at = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
                for part in table if whole.any() else ():
                    base, c = part.value
                    where, d2, _ = nearest(x[whole], c)
                    wins = d2 < best[whole]
                    at[whole], best[whole] = np.where(wins, base + where, at[whole]), np.where(wins, d2, best[whole])
                yield pa.record_batch([*some.columns[:-1], pa.array(at.astype(np.int32), mask=~whole), pa.array(best, mask=~whole)], schema=pa.schema([*some.schema][:-1] + [pa.field(name, pa.int32()), pa.field("d2", pa.float64())]))

    return staged.select(*there, "__x").mapInArrow(run, schema)


def _sums(state: DataFrame) -> DataFrame:
    """(cluster, total, n): coordinate sums, one row per cluster and task before the shuffle."""
    schema = "cluster long, total array<double>, n long"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            x, cluster = matrix(batch.column(0))[0], batch.column(1).to_numpy()
            order = np.argsort(cluster, kind="stable")
            keys, first = np.unique(cluster[order], return_index=True)
            for k, part, n in zip(keys.tolist(), np.add.reduceat(x[order], first, axis=0) if len(keys) else (), np.diff(np.append(first, len(cluster))).tolist()):
                sums[k], counts[k] = sums.get(k, 0.0) + part, counts.get(k, 0) + n
        yield pa.record_batch([pa.array(list(sums), pa.int64()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64())), pa.array(list(counts.values()), pa.int64())], names=["cluster", "total", "n"])

    def merge(group: pa.Table) -> pa.Table:
        total = matrix(group["total"].combine_chunks())[0].sum(axis=0)
        return pa.table({"cluster": group["cluster"][:1], "total": pa.array([total.tolist()], pa.list_(pa.float64())), "n": pa.array([sum(group["n"].to_pylist())], pa.int64())})

    return state.select("x", "cluster").mapInArrow(add, schema).groupBy("cluster").applyInArrow(merge, schema)


def kmeans_many(points: DataFrame, centroids: np.ndarray, feat: str = "features", tol: float = 0.1, max_iter: int | None = None) -> KMeansResult:
    """Lloyd iterations as in :func:`cluster.kmeans` (empty clusters drop, ids are renumbered), with
    bounds carried per point; equal results for up to rounding of the centroid sums.

    Each iteration writes the points with their bounds to the scratch folder and reads them once
    more for the sums. ``history`` holds (iteration, unconverged, clusters); ``distances`` how many
    points needed distances in each iteration. Vectors that are NULL or not whole take no part.
    """
    spark = points.sparkSession
    path = scratch_path(spark, "kmeans-many")
    current = np.asarray(centroids, float)
    schema = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("cluster", T.LongType()), T.StructField("upper", T.DoubleType()), T.StructField("lower", T.DoubleType()), T.StructField("measured", T.BooleanType())])
    start = points.select(to_double_array(feat).alias("x")).where(F.col("x").isNotNull())
    state = start.select("x", F.lit(-1).cast("long").alias("cluster"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"))
    result = KMeansResult(centroids=current.tolist())
    result.distances = []
    moved = (np.full(len(current), -1), np.zeros(len(current)))
    it = 0
    while not result.converged:
        if it == max_iter:
            raise RuntimeError(f"no convergence within {max_iter} iterations")
        it += 1
        shared = spark.sparkContext.broadcast((current, *moved))

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c, number, shift = shared.value  # number and shift: by the cluster ids of the iteration before
            most = shift.max(initial=0.0)
            for batch in batches:
                for a in range(0, batch.num_rows, ROWS):
                    some = batch.slice(a, ROWS)
                    x, whole = matrix(some.column(0))
                    was, upper, lower = (some.column(i).to_numpy().copy() for i in (1, 2, 3))
                    known = was >= 0
                    upper[known] += shift[was[known]]
                    lower -= most
                    was[known] = number[was[known]]
                    # Rounding of bounds and distances must not keep a point where it is.
                    ask = whole & ~(known & (was >= 0) & (upper * (1 + 1e-9) + 1e-9 < lower))
                    if ask.any():
                        at, d2, second = nearest(x[ask], c)
                        was[ask], upper[ask], lower[ask] = at, np.sqrt(d2), second
                    yield pa.record_batch([some.column(0), pa.array(was), pa.array(upper), pa.array(lower), pa.array(ask)], names=schema.names).filter(pa.array(whole))

        state.mapInArrow(step, schema).write.parquet(f"{path}/{it}")
        state = spark.read.schema(schema).parquet(f"{path}/{it}")
        result.distances.append(state.agg(F.count_if("measured")).first()[0])
        new = {r["cluster"]: np.array(r["total"]) / r["n"] for r in _sums(state).collect()}  # k rows
        kept = sorted(new)
        number, shift = np.full(len(current), -1), np.zeros(len(current))
        for i, k in enumerate(kept):
            number[k], shift[k] = i, float(np.sqrt(((new[k] - current[k]) ** 2).sum()))
            result.centroid_history.append((it, k, new[k].tolist(), float(shift[k])))
        current, moved = np.array([new[k] for k in kept]).reshape(len(kept), -1), (number, shift)
        unconverged = int((shift > tol).sum())
        result.history.append((it, unconverged, len(kept)))
        result.converged = unconverged == 0
        state = state.drop("measured")
    result.centroids = current.tolist()
    return result
