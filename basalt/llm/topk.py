"""Exact top-k inner products over an impact-ordered index, score at a time.

Components are integers. Every dimension has two posting lists: one by the distance above the
block's smallest value, for positive query weights, and one by the distance below its largest,
for negative ones. So each contribution of a list to a score, weight times impact, is at least 0.
Impacts are quantised into levels; a list's postings of one level are a segment.

Segments are read by descending level, EVERY levels at a time. Reading adds weight * level to the
accumulators of their rows, for all queries of a batch in one product. What is still unread lies below the level read
last, so after each level every row has a score that it surely reaches and one that it cannot
pass. A query stops once these prove that few rows can still be among its best; those few are
scored exactly. The postings below are then never read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.session import scratch_path

LEVELS = 32
EVERY = 8  # levels between two looks at the bounds
POSSIBLE = 8  # a query stops when at most this many times k rows are possible


class Index:
    """The impact-ordered posting lists of one block of rows."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)
        self.width = max(1, -(-int((self.high - self.low).max() + 1) // LEVELS))
        impacts = np.concatenate([vectors - self.low, self.high - vectors], axis=1)
        levels = impacts // self.width
        self.top = int(levels.max(initial=0))
        # Each list's rows by descending level, and where each level begins in it.
        self.postings = np.argsort(-levels, axis=0, kind="stable").T.astype(np.int32)
        ordered = np.take_along_axis(-levels, self.postings.T, axis=0).T
        self.begins = np.stack([np.searchsorted(o, np.arange(-self.top, 2)) for o in ordered])
        self.read = 0  # postings read so far, over all lists and batches

    def segment(self, which: int, level: int) -> np.ndarray:
        at = self.top - level
        return self.postings[which, self.begins[which, at] : self.begins[which, at + 1]]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of each query's best k rows; ties go to the smaller row. ``own`` is the
        row that a query does not count, or -1."""
        n, none = len(self.vectors), np.zeros(0, np.int64)
        weights = np.concatenate([np.maximum(queries, 0), np.maximum(-queries, 0)], axis=1)
        most = int(weights.sum(axis=1, dtype=object).max(initial=0)) * self.width * (self.top + 2)
        if most >= 2**62:
            raise OverflowError("inner products beyond 2**62")
        kind = np.float64 if most < 2**53 else np.int64  # whole numbers stay exact in either
        out, active = [(none, none, none)], np.arange(len(queries))
        weights = np.ascontiguousarray(weights.T.astype(kind))  # lists x active queries
        total = weights.sum(axis=0)
        # Accumulators of each row and query: the sum of weight * level, and that of the weights read.
        levels, seen = np.zeros((n, len(queries)), kind), np.zeros((n, len(queries)), kind)
        last = self.top + 1
        for level in [x for x in range(self.top, 0, -1) if x % EVERY == 1] or [1]:
            read = np.flatnonzero(weights.any(axis=1))
            part, there = np.zeros((n, len(read)), kind), np.zeros((n, len(read)), kind)
            for i, which in enumerate(read.tolist()):  # the segments of the levels from last - 1 to level
                for x in range(last - 1, level - 1, -1):
                    rows = self.segment(which, x)
                    part[rows, i], there[rows, i] = x, 1
                    self.read += len(rows)
            levels += part @ weights[read]
            seen += there @ weights[read]
            last = level
            # Read postings lie within their level, unread ones below this one.
            at_least = levels * self.width
            at_most = at_least + seen * (self.width - 1) + (total - seen) * (level * self.width - 1)
            mine = np.flatnonzero(own[active] >= 0)
            at_least[own[active][mine], mine] = -1
            kth = np.partition(np.ascontiguousarray(at_least.T), n - k, axis=1)[:, n - k] if n > k else np.zeros(len(active), kind)
            possible = at_most >= kth
            possible[own[active][mine], mine] = False
            # Level 0 is never read: what is possible by then is scored.
            done = (possible.sum(axis=0) <= POSSIBLE * k) | (level == 1)
            if not done.any():
                continue
            q, r = np.nonzero(possible[:, done].T)
            q = active[done][q]
            score = np.empty(len(q), np.int64)
            for a in range(0, len(q), 1 << 16):  # the possible members, exactly
                s = slice(a, a + (1 << 16))
                score[s] = np.einsum("ij,ij->i", queries[q[s]], self.vectors[r[s]])
            order = np.lexsort((r, -score, q))
            q, r, score = q[order], r[order], score[order]
            best = np.arange(len(q)) - np.searchsorted(q, q) < k
            out.append((q[best], r[best], score[best]))
            active, total, weights = active[~done], total[~done], np.ascontiguousarray(weights[:, ~done])
            levels, seen = np.ascontiguousarray(levels[:, ~done]), np.ascontiguousarray(seen[:, ~done])
            if not len(active):
                break
        return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def integer_vectors(vectors: DataFrame, is_query: Column, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """(uid, id, v, dim, query): components as floor(scale * x); vectors null, empty or with a null or
    non-finite component are left out, and so are null ids."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & ~bad).select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * scale)).cast("array<long>").alias("v"),
        F.size(vector_col).alias("dim"), F.coalesce(is_query, F.lit(False)).alias("query"),
    )


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding", index_rows: int = 4096, query_rows: int = 512) -> DataFrame:
    """For each row marked by ``is_query`` its k highest inner products over all other rows.

    Columns ``query_id``, ``rank`` (from 1), the id, ``score`` (exact integer); ties go to the smaller id. Rows
    are told apart by place: rows that share an id are candidates of one another, and each asks
    if it is marked. Candidates have the query's dimension. Vectors null, empty, or with a null or
    non-finite component take no part (nor do null ids); a score beyond 62 bits raises. An empty
    table gives an empty result. Other columns are read only as far as ``is_query`` names them.

    Tasks hold an index of ``index_rows`` rows and a batch of ``query_rows`` queries (in expectation: rows
    are dealt by hash); every index meets every batch, and their results are merged.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "top-k")
    integer_vectors(vectors, is_query, scale, id_col, vector_col).write.parquet(path)
    rows = spark.read.parquet(path)
    n, m = rows.agg(F.count(F.lit(1)), F.count_if("query")).first()
    index_blocks, query_blocks = max(1, math.ceil(n / index_rows)), max(1, math.ceil(m / query_rows))

    def numbers(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def block(count: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(count)).cast("int")

    left = rows.drop("query").withColumn("iblock", block(index_blocks, 0)).withColumn("qblock", numbers(query_blocks))
    right = rows.filter("query").drop("query").withColumn("qblock", block(query_blocks, 1)).withColumn("iblock", numbers(index_blocks))
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("query", "query_id", "uid", "id", "score")])

    def matrix(t: pa.Table) -> np.ndarray:
        return t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)

    def search(some: pa.Table, asked: pa.Table) -> pa.Table:
        if not some.num_rows or not asked.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in schema.names})
        some = some.sort_by([("id", "ascending"), ("uid", "ascending")])
        uids, ids, who, query_ids = some["uid"].to_numpy(), some["id"].to_numpy(), asked["uid"].to_numpy(), asked["id"].to_numpy()
        order = np.argsort(uids)
        at = order[np.minimum(np.searchsorted(uids, who, sorter=order), len(uids) - 1)]
        q, r, scores = Index(matrix(some)).search(matrix(asked), np.where(uids[at] == who, at, -1), k)
        return pa.table({"query": who[q], "query_id": query_ids[q], "uid": uids[r], "id": ids[r], "score": scores})

    key = ["iblock", "qblock", "dim"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, schema)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id", "uid")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
