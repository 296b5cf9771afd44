"""Hard negatives by bounds along a spanning tree of anchors.

Anchors are dealt into blocks, and each block gets a minimum spanning tree. A candidate x that
scores s at a parent anchor p scores between s - d * |x| and s + d * |x| at a child c, where d is the length
of the edge (the distance of p and c): c.x = p.x + (c - p).x. So a block of candidates is scored
whole at the root only; further down, every candidate carries an interval, and only those whose
interval overlaps what the anchor asks for (its best positives, or its windows of negative
scores) are scored exactly. An exact score is a point again for the children to start from.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.session import scratch_path

EXACT = 2**53  # whole numbers below it are exact in double precision


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order (a parent precedes its children), parent of each row (-1: the root) and the length
    of the edge to it: the minimum spanning tree grown from the row nearest to the mean."""
    v = vectors.astype(np.float64)
    n = len(v)
    order, parent, length = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    near, by, left = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    at = int(((v - v.mean(axis=0)) ** 2).sum(axis=1).argmin())
    for i in range(n):
        order[i], parent[at], left[at] = at, by[at], False
        length[at] = 0.0 if by[at] < 0 else math.sqrt(near[at])
        apart = ((v - v[at]) ** 2).sum(axis=1)
        closer = left & (apart < near)
        near[closer], by[closer] = apart[closer], at
        if i + 1 < n:
            at = int(np.where(left, near, np.inf).argmin())
    return order, parent, length


class Block:
    """Candidates of one block, with their norms; counts the exact scores it computes."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(np.float64)
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.whole, self.rescored = vectors, 0

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products; numbers too large for doubles go through Python's integers."""
        self.rescored += len(rows)
        if np.abs(anchor.astype(np.float64)).sum() * (np.abs(self.vectors).max(initial=0) or 1) < EXACT:
            return self.vectors[rows] @ anchor.astype(np.float64)
        return np.array([sum(int(a) * int(b) for a, b in zip(anchor, self.whole[r])) for r in rows], object)

    def walk(self, anchors: np.ndarray, parent: np.ndarray, length: np.ndarray, wanted: Callable) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, candidates, exact scores) for each anchor, parents first.

        ``anchors`` stand in tree order with the position of their ``parent`` (-1 for a root).
        ``wanted(anchor, low, high)`` marks the candidates whose interval calls for a score.
        """
        waiting = np.bincount(parent[parent >= 0], minlength=len(anchors))
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for a in range(len(anchors)):
            p = int(parent[a])
            if p < 0:
                low, high, rows = np.empty(len(self.norms)), np.empty(len(self.norms)), np.arange(len(self.norms))
            else:
                # Rounding stays within the widening, so an interval never misses its score.
                reach = length[a] * self.norms * (1 + 1e-9) + 1e-6
                low, high = known[p][0] - reach, known[p][1] + reach
                low, high = low - np.abs(low) * 1e-12, high + np.abs(high) * 1e-12
                waiting[p] -= 1
                if not waiting[p]:
                    del known[p]
                rows = np.flatnonzero(wanted(a, low, high))
            exact = self.scores(anchors[a], rows)
            low[rows] = high[rows] = exact.astype(np.float64)
            if waiting[a]:
                known[a] = (low, high)
            yield a, rows, exact


def best_wanted(low: np.ndarray, high: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Allowed candidates that may be among the k best: those not below the k-th lower end."""
    ends = low[allowed]
    if len(ends) <= k:
        return allowed
    return allowed & (high >= np.partition(ends, len(ends) - k)[len(ends) - k])


def windows_wanted(low: np.ndarray, high: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], k: int) -> np.ndarray:
    """Allowed candidates that may be among the k best of a window (least, most score): their
    interval overlaps it and does not lie below k intervals that are surely inside."""
    out = np.zeros(len(low), bool)
    for least, most in windows:
        overlaps = allowed & (high >= least) & (low <= most)
        inside = low[overlaps & (low >= least) & (high <= most)]
        if len(inside) > k:
            overlaps &= high >= np.partition(inside, len(inside) - k)[len(inside) - k]
        out |= overlaps
    return out


def window_of(positive: int, lowest: tuple[int, int], highest: tuple[int, int]) -> tuple[int, int]:
    """Least and most whole score s with lowest * positive <= s <= highest * positive."""
    return -(-lowest[0] * positive // lowest[1]), highest[0] * positive // highest[1]


def _matrix(t: pa.Table, name: str) -> np.ndarray:
    column = t[name].combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def _usable(vectors: DataFrame, is_anchor: Column, label: Column, scale: float, id_col: str, vector_col: str) -> DataFrame:
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (
        vectors.filter(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & ~bad)
        .select(
            F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"),
            F.transform(x, lambda c: F.floor(c * scale)).cast("array<long>").alias("v"), F.size(vector_col).alias("dim"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        )
    )


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, lowest: tuple[int, int] = (50, 100),
    highest: tuple[int, int] = (95, 100), scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 4096, anchor_rows: int = 1024,
) -> DataFrame:
    """For each anchor and each of its best ``positives``, the best ``negatives`` inside the window.

    Components count as floor(scale * x); a score is the integer inner product with the anchor, and
    ties go to the smaller id. An anchor's positives are its best other rows of the same ``label``;
    for each of them the rows of other labels with lowest * positive score <= score <= highest *
    positive score are its negatives, the best of which are returned: ``anchor_id``, ``positive_id``,
    ``rank`` (from 1, among those returned), ``negative_id``, ``positive_score``, ``negative_score``.

    Rows with a null id, label or vector, an empty vector or a null or non-finite component take
    no part. Vectors of another length than the anchor's are no candidates. Rows are told apart by
    place, so rows that share an id are candidates of one another and anchors each. A score beyond
    64 bits raises. Without an
    anchor, a positive or a row in a window there is no row; an empty table gives an empty
    result. Other columns are read only as far as ``is_anchor`` and ``label`` name them.

    Tasks hold a block of candidates and a block of anchors, whatever the labels' shares; both sizes
    are parameters, every block of one meets every block of the other.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "hard-negatives")
    _usable(vectors, is_anchor, label, scale, id_col, vector_col).write.parquet(f"{path}-rows")
    rows = spark.read.parquet(f"{path}-rows")
    n, m = rows.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    blocks, anchor_blocks = max(1, math.ceil(n / block_rows)), max(1, math.ceil(m / anchor_rows))

    def dealt(count: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(count)).cast("int")

    def each(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    key = ["block", "ablock", "dim"]
    longs, one = T.ArrayType(T.LongType()), T.LongType()
    _trees(rows.filter("anchor").withColumn("ablock", dealt(anchor_blocks, 1))).write.parquet(f"{path}-trees")
    trees = spark.read.parquet(f"{path}-trees")
    candidates = rows.select("uid", "id", "label", "v", "dim").withColumn("block", dealt(blocks, 0)).withColumn("ablock", each(anchor_blocks))

    def pairs(search: Callable, asked: DataFrame, schema: T.StructType) -> DataFrame:
        names = schema.names

        def run(some: pa.Table, anchors: pa.Table) -> pa.Table:
            if not some.num_rows or not anchors.num_rows:
                return pa.table({f.name: pa.array([], pa.int32() if isinstance(f.dataType, T.IntegerType) else pa.int64()) for f in schema})
            some, anchors = some.sort_by([("id", "ascending"), ("uid", "ascending")]), anchors.sort_by("place")
            found = list(search(some, anchors))
            return pa.table({c: np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64) for i, c in enumerate(names)})

        return candidates.groupBy(*key).cogroup(asked.withColumn("block", each(blocks)).groupBy(*key)).applyInArrow(run, schema)

    def common(some: pa.Table, anchors: pa.Table) -> tuple:
        codes = {x: i for i, x in enumerate(sorted(set(some["label"].to_pylist()) | set(anchors["label"].to_pylist())))}
        of = [np.array([codes[x] for x in t["label"].to_pylist()]) for t in (some, anchors)]
        return some["uid"].to_numpy(), some["id"].to_numpy(), *of, anchors["uid"].to_numpy(), Block(_matrix(some, "v")), (_matrix(anchors, "v"), anchors["parent"].to_numpy(), anchors["length"].to_numpy())

    def find_positives(some: pa.Table, anchors: pa.Table) -> Iterator[tuple]:
        uid, ids, labels, own, asked, block, tree = common(some, anchors)

        def allowed(a: int) -> np.ndarray:
            return (labels == own[a]) & (uid != asked[a])

        for a, at, score in block.walk(*tree, lambda a, low, high: best_wanted(low, high, allowed(a), positives)):
            fits = allowed(a)[at]
            at, score = at[fits], score[fits]
            best = np.argsort(-score, kind="stable")[:positives]  # rows stand in id order
            yield np.full(len(best), asked[a]), ids[at[best]], uid[at[best]], score[best].astype(np.int64)

    found = pairs(find_positives, trees, _fields(anchor=one, positive_id=one, uid=one, positive_score=one))
    best = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "uid")
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("p")).select(
        F.col("anchor").alias("uid"), F.col("p.positive_id").alias("positive_ids"), F.col("p.positive_score").alias("positive_scores")
    ).write.parquet(f"{path}-positives")
    with_positives = trees.join(spark.read.schema(_fields(uid=one, positive_ids=longs, positive_scores=longs)).parquet(f"{path}-positives"), "uid", "left")

    def find_negatives(some: pa.Table, anchors: pa.Table) -> Iterator[tuple]:
        uid, ids, labels, own, asked, block, tree = common(some, anchors)
        scores = [x or [] for x in anchors["positive_scores"].to_pylist()]
        windows = [[window_of(p, lowest, highest) for p in of] for of in scores]

        def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            return windows_wanted(low, high, labels != own[a], [w for w in windows[a] if w[0] <= w[1]], negatives)

        for a, at, score in block.walk(*tree, wanted):
            fits = labels[at] != own[a]
            at, score = at[fits], score[fits]
            order = np.argsort(-score, kind="stable")
            at, falling = at[order], -score[order]
            for place, (least, most) in enumerate(windows[a]):
                begin, end = np.searchsorted(falling, -most, "left"), np.searchsorted(falling, -least, "right")
                best = slice(begin, max(begin, min(end, begin + negatives)))
                k = len(falling[best])
                yield np.full(k, asked[a]), np.full(k, place), ids[at[best]], uid[at[best]], (-falling[best]).astype(np.int64)

    found = pairs(find_negatives, with_positives, _fields(anchor=one, place=one, negative_id=one, negative=one, negative_score=one))
    best = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id", "negative")
    found = found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= negatives)
    asked = with_positives.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"), F.posexplode(F.arrays_zip("positive_ids", "positive_scores")).alias("p", "x"))
    asked = asked.select("anchor", F.col("p").cast("long").alias("place"), "anchor_id", F.col("x.positive_ids").alias("positive_id"), F.col("x.positive_scores").alias("positive_score"))
    return found.join(asked, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _trees(anchors: DataFrame) -> DataFrame:
    """Anchors with their place in tree order, the place of their parent and the edge to it."""
    schema = _fields(uid=T.LongType(), id=T.LongType(), label=T.StringType(), v=T.ArrayType(T.LongType()), dim=T.IntegerType(), ablock=T.IntegerType(),
                     place=T.LongType(), parent=T.LongType(), length=T.DoubleType())

    def plant(group: pa.Table) -> pa.Table:
        group = group.sort_by("uid")
        order, parent, length = spanning_tree(_matrix(group, "v"))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        out = group.select(["uid", "id", "label", "v", "dim", "ablock"])
        return out.append_column("place", pa.array(place)).append_column("parent", pa.array(np.where(parent < 0, -1, place[parent]))).append_column("length", pa.array(length))

    return anchors.groupBy("ablock", "dim").applyInArrow(plant, schema)
