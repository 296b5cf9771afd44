"""Logistic regression by full-batch gradient ascent, scoring, weight grids, and linear
margin scoring on quadratic features.

Model semantics kept from the exercise: weights start at 0, no intercept, no penalty;
the gradient is the *sum* over rows of ``(y - p) * x``; ``updates`` steps (49 by default,
iterations 1..49); learning rate ``eta * exp(-i/step)`` (``decay="exp"``) or the
integer-division variant ``eta * exp(-ceil(i/step))`` (``decay="staircase"``).

Distributed shape: the d-vector of weights (or R×d for a sweep) lives on the driver and
travels with the task; errors and their products with the features are two matrix products
per Arrow batch (``mapInArrow``), so R×d partial sums per task cross the shuffle. One job
per update, for all runs at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.functions.batches import matrix
from basalt.functions.vectors import dot, lit_matrix, lit_vector, of_width, sigmoid, to_double_array


def binarize(df: DataFrame, label: str, positive, name: str = "y") -> DataFrame:
    """``name`` = 1 where ``label == positive`` else 0 (one expression, no statement order)."""
    return df.withColumn(name, (F.col(label) == F.lit(positive)).cast("int"))


def learning_rate(eta: float, step: float, i: int, decay: str = "staircase") -> float:
    if decay == "exp":
        return eta * math.exp(-i / step)
    if decay == "staircase":
        return eta * math.exp(-math.ceil(i / step))
    raise ValueError("decay must be 'exp' or 'staircase'")


def gradients(data: DataFrame, weights: Sequence[Sequence[float]], feat: str = "features", y: str = "y") -> DataFrame:
    """Long form ``(run, j, g)``: gradient of every run's log-likelihood at its weights.

    Rows whose label is NULL or NaN and vectors that are NULL or have a NULL, NaN or infinite element
    add nothing; they are told apart inside the batch, so no other row is lost with them. A
    vector of another width than the weights fails the job.
    """
    w = np.asarray(weights, float)
    schema = T.StructType([T.StructField("run", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("g", T.DoubleType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(w)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, whole = matrix(batch.column(0))
            truth = batch.column(1).to_numpy(zero_copy_only=False)
            whole &= np.isfinite(truth)
            x, truth = x[whole], truth[whole]
            with np.errstate(over="ignore"):
                err = truth[:, None] - 1.0 / (1.0 + np.exp(-(x @ w.T)))
            total += err.T @ x
        run, j = np.indices(w.shape, dtype="int32")
        yield pa.record_batch({"run": run.ravel(), "j": j.ravel(), "g": total.ravel()})

    rows = data.select(of_width(feat, w.shape[1]).alias("x"), F.col(y).cast("double").alias("y"))
    rows = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    return rows.mapInArrow(add, schema).groupBy("run", "j").agg(F.sum("g").alias("g"))


def gradient(data: DataFrame, w: Sequence[float], feat: str = "features", y: str = "y") -> DataFrame:
    """Long form ``(j, g)`` for one weight vector."""
    return gradients(data, [w], feat, y).select("j", "g")


def fit_many(
    data: DataFrame,
    runs: Sequence[tuple[float, float]],
    d: int,
    feat: str = "features",
    y: str = "y",
    updates: int = 49,
    decay: str = "staircase",
) -> list[list[float]]:
    """Train several (eta, step) runs together; returns one weight vector per run."""
    cached = data.select(to_double_array(feat).alias(feat), F.col(y)).persist(StorageLevel.MEMORY_AND_DISK)
    W = [[0.0] * d for _ in runs]
    try:
        for i in range(1, updates + 1):
            for r in gradients(cached, W, feat, y).collect():
                eta, step = runs[r["run"]]
                W[r["run"]][r["j"]] += learning_rate(eta, step, i, decay) * r["g"]
    finally:
        cached.unpersist()
    return W


def fit(data: DataFrame, eta: float, step: float, d: int, feat: str = "features", y: str = "y", updates: int = 49, decay: str = "staircase") -> list[float]:
    return fit_many(data, [(eta, step)], d, feat, y, updates, decay)[0]


def weights_frame(spark: SparkSession, weights: Mapping[str, Sequence[float]]) -> DataFrame:
    """Coefficient table ``(run_id, j, w)`` (the Parquet-friendly model format)."""
    rows = [(rid, j, float(v)) for rid, w in weights.items() for j, v in enumerate(w)]
    return spark.createDataFrame(rows, "run_id STRING, j INT, w DOUBLE")


def score_runs(data: DataFrame, weights: Mapping[str, Sequence[float]], feat: str = "features", y: str = "y", threshold: float = 0.5) -> DataFrame:
    """Accuracy of every run in one pass: predict 1 when p >= threshold (inclusive). Rows with a NULL
    label are left out."""
    ids = list(weights)
    x = of_width(feat, len(weights[ids[0]]))
    preds = F.transform(
        lit_matrix([weights[r] for r in ids]),
        lambda w, r: F.struct(r.alias("run"), (sigmoid(dot(x, w)) >= threshold).cast("int").alias("pred")),
    )
    per = data.select(F.col(y), F.explode(preds).alias("s"))
    names = F.array(*[F.lit(r) for r in ids])
    acc = per.groupBy(F.col("s.run").alias("run")).agg(F.avg((F.col("s.pred") == F.col(y)).cast("double")).alias("accuracy"))
    return acc.select(F.element_at(names, F.col("run") + 1).alias("run_id"), "accuracy")


def predict(data: DataFrame, w: Sequence[float], feat: str = "features", threshold: float = 0.5) -> DataFrame:
    """Add probability ``p`` and 0/1 ``prediction`` for one weight vector."""
    p = sigmoid(dot(of_width(feat, len(w)), lit_vector(w)))
    return data.withColumn("p", p).withColumn("prediction", (F.col("p") >= threshold).cast("int"))


def minmax_grid(weights: DataFrame, width: int, j: str = "j", w: str = "w", negate: bool = True, lo: float = 0.0, hi: float = 255.0) -> DataFrame:
    """Scale (optionally negated) weights to [lo, hi] and lay them out as a width-wide grid.

    max == min maps everything to ``lo``. A weight table has as many rows as the model has
    features, so its minimum and maximum come from one window over that small table.
    """
    v = -F.col(w) if negate else F.col(w)
    vals = weights.select(F.col(j), v.alias("_v"))
    every = Window.partitionBy()
    mn, mx = F.min("_v").over(every), F.max("_v").over(every)
    scaled = F.when(mx > mn, (F.col("_v") - mn) / (mx - mn)).otherwise(F.lit(0.0)) * (hi - lo) + lo
    return vals.select(
        (F.col(j) / width).cast("int").alias("row"), (F.col(j) % width).cast("int").alias("col"), scaled.alias("pixel")
    )


def quadratic(df: DataFrame, x1: str = "x1", x2: str = "x2") -> DataFrame:
    """Add the quadratic features ``x1_sq`` = x1² and ``x1x2`` = x1·x2."""
    return df.withColumn("x1_sq", F.col(x1) * F.col(x1)).withColumn("x1x2", F.col(x1) * F.col(x2))


def margin_score(
    df: DataFrame,
    coef: Mapping[str, float],
    bias: float,
    margin: float,
    pos: str = "A",
    neg: str = "B",
    digits: int = 9,
) -> DataFrame:
    """Score rows with a given linear separator ``f = Σ coef·x + bias``.

    Adds ``f``, ``label`` (pos if f > 0), ``in_margin`` (|f| < margin) and ``support``
    (|f| == margin, compared after rounding to ``digits``).
    """
    f: Column = F.lit(float(bias))
    for c, a in coef.items():
        f = f + F.lit(float(a)) * F.col(c)
    return (
        df.withColumn("f", f)
        .withColumn("label", F.when(F.col("f") > 0, F.lit(pos)).otherwise(F.lit(neg)))
        .withColumn("in_margin", F.abs("f") < margin)
        .withColumn("support", F.round(F.abs("f"), digits) == margin)
    )
