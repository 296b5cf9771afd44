"""Registered queries: logistic regression (label 8 vs rest on embeddings), weight grid,
quadratic features and margin scoring (lineitem discount/tax as the two inputs).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basalt.functions.vectors import to_double_array, vadd, vscale
from basalt.operators import linear
from basalt.plans.registry import Tables, query
from basalt.session import scratch_path
from basalt.sinks.files import load_coefficients, save_coefficients

DIM = 64
POSITIVE = 8
ETA, STEP, DECAY = 0.1, 50, "staircase"
# The six (eta, step) runs of the reference's parameter sweep.
SWEEP = {
    "eta0.1_step5": (0.1, 5),
    "eta0.1_step50": (0.1, 50),
    "eta0.0001_step50": (0.0001, 50),
    "eta1_step3": (1.0, 3),
    "eta0.5_step5": (0.5, 5),
    "eta0.5_step10": (0.5, 10),
}

_DATA = f"""
d AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CAST(label = {POSITIVE} AS INTEGER) AS y FROM embeddings),
x1 AS (SELECT y, UNNEST(range(len(x))) AS j, UNNEST(x) AS v FROM d),
g1 AS (SELECT j, SUM((y - 0.5) * v) AS g FROM x1 GROUP BY j),
w1 AS (SELECT j, {ETA} * exp(-1) * g AS w FROM g1)
"""


def _data(t: Tables):
    return linear.binarize(t.embeddings, "label", POSITIVE).select("vec_id", F.col("embedding").alias("features"), "y")


@query("binarize_label", f"SELECT vec_id, CAST(label = {POSITIVE} AS INTEGER) AS y FROM embeddings")
def binarize_label(spark, sf_dir):
    return linear.binarize(Tables(spark, sf_dir).embeddings, "label", POSITIVE).select("vec_id", "y")


@query(
    "logistic_step",
    f"WITH {_DATA} SELECT CAST(g1.j AS INTEGER) AS j, ROUND(g, 6) AS gradient, ROUND(w, 6) AS weight FROM g1 JOIN w1 ON g1.j = w1.j",
)
def logistic_step(spark, sf_dir):
    g = linear.gradient(_data(Tables(spark, sf_dir)), [0.0] * DIM)
    lr = linear.learning_rate(ETA, STEP, 1, DECAY)
    return g.select("j", F.round("g", 6).alias("gradient"), F.round(F.col("g") * lr, 6).alias("weight"))


@query(
    "logistic_step_missing",
    f"""
    WITH d AS (SELECT CAST(embedding AS DOUBLE[]) AS x, CAST(label = {POSITIVE} AS INTEGER) AS y FROM embeddings WHERE vec_id % 17 <> 3 AND vec_id % 19 <> 4 AND vec_id % 23 <> 5),
    x1 AS (SELECT y, UNNEST(range(len(x))) AS j, UNNEST(x) AS v FROM d)
    SELECT CAST(j AS INTEGER) AS j, ROUND(SUM((y - 0.5) * v), 6) AS gradient FROM x1 GROUP BY j
    """,
)
def logistic_step_missing(spark, sf_dir):
    """A gradient in which rows with a missing element (NaN, NULL) or label take no part."""
    data = _data(Tables(spark, sf_dir))
    at = F.pmod("vec_id", F.lit(DIM)).cast("int")
    nan, null = F.col("vec_id") % 17 == 3, F.col("vec_id") % 19 == 4
    holed = F.transform(F.col("features").cast("array<double>"), lambda v, i: F.when((i == at) & nan, F.lit(float("nan"))).when((i == at) & null, F.lit(None)).otherwise(v))
    data = data.withColumn("features", holed).withColumn("y", F.when(F.col("vec_id") % 23 != 5, F.col("y")))
    return linear.gradient(data, [0.0] * DIM).select("j", F.round("g", 6).alias("gradient"))


@query(
    "logistic_two_steps",
    f"""
    WITH {_DATA},
    wl AS (SELECT list(w ORDER BY j) AS w FROM w1),
    e2 AS (SELECT d.x, d.y - 1 / (1 + exp(-list_inner_product(d.x, wl.w))) AS err FROM d, wl),
    x2 AS (SELECT err, UNNEST(range(len(x))) AS j, UNNEST(x) AS v FROM e2),
    g2 AS (SELECT j, SUM(err * v) AS g FROM x2 GROUP BY j)
    SELECT CAST(g2.j AS INTEGER) AS j, ROUND(w1.w + {ETA} * exp(-1) * g2.g, 6) AS weight
    FROM g2 JOIN w1 ON g2.j = w1.j
    """,
)
def logistic_two_steps(spark, sf_dir):
    data = _data(Tables(spark, sf_dir))
    lr1 = linear.learning_rate(ETA, STEP, 1, DECAY)
    w1 = [0.0] * DIM
    for r in linear.gradient(data, [0.0] * DIM).collect():
        w1[r["j"]] = lr1 * r["g"]
    lr2 = linear.learning_rate(ETA, STEP, 2, DECAY)
    w1_lit = F.array(*[F.lit(v) for v in w1])
    g2 = linear.gradient(data, w1)
    return g2.select("j", F.round(F.element_at(w1_lit, F.col("j") + 1) + F.col("g") * lr2, 6).alias("weight"))


@query(
    "weight_grid",
    f"""
    WITH {_DATA},
    v AS (SELECT j, -w AS v FROM w1),
    mm AS (SELECT MIN(v) AS mn, MAX(v) AS mx FROM v)
    SELECT CAST(j // 8 AS INTEGER) AS row, CAST(j % 8 AS INTEGER) AS col,
           ROUND(COALESCE((v - mn) / NULLIF(mx - mn, 0), 0) * 255, 6) AS pixel
    FROM v, mm
    """,
)
def weight_grid(spark, sf_dir):
    """Min-max image of the negated one-step weights on an 8×8 grid."""
    g = linear.gradient(_data(Tables(spark, sf_dir)), [0.0] * DIM)
    w = g.select("j", (F.col("g") * linear.learning_rate(ETA, STEP, 1, DECAY)).alias("w"))
    grid = linear.minmax_grid(w, width=8)
    return grid.withColumn("pixel", F.round("pixel", 6))


def _runs_sql(runs, updates: int, select: str, decay: str = "ceil") -> str:
    """All runs trained by a recursive query, one update per step, then ``select``."""
    values = ", ".join(f"('{rid}', CAST({eta} AS DOUBLE), CAST({step} AS DOUBLE))" for rid, (eta, step) in runs.items())
    share = "ceil((i + 1) / step)" if decay == "ceil" else "(i + 1) / step"
    return f"""
    WITH RECURSIVE d AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CAST(label = {POSITIVE} AS INTEGER) AS y FROM embeddings),
    r(run_id, eta, step) AS (VALUES {values}),
    t(i, run_id, eta, step, w) AS (
        SELECT 0, run_id, eta, step, list_transform(range({DIM}), lambda k: CAST(0 AS DOUBLE)) FROM r
        UNION ALL
        SELECT i + 1, run_id, eta, step, list(nw ORDER BY j) FROM (
            SELECT i, run_id, eta, step, j, any_value(w[j + 1]) + eta * exp(-{share}) * SUM(err * v) AS nw FROM (
                SELECT t.*, d.y - 1 / (1 + exp(-list_inner_product(d.x, t.w))) AS err, unnest(range(len(d.x))) AS j, unnest(d.x) AS v
                FROM t, d WHERE i < {updates})
            GROUP BY i, run_id, eta, step, j)
        GROUP BY i, run_id, eta, step)
    {select.format(updates=updates)}
    """


_WEIGHTS = "SELECT run_id, CAST(j AS INTEGER) AS j, ROUND(v, 4) AS w FROM (SELECT run_id, unnest(range(len(w))) AS j, unnest(w) AS v FROM t WHERE i = {updates})"
_ACCURACY = (
    "SELECT run_id, AVG(CAST((1 / (1 + exp(-list_inner_product(d.x, t.w))) >= 0.5) = (d.y = 1) AS DOUBLE)) AS accuracy "
    "FROM t, d WHERE i = {updates} GROUP BY run_id"
)
ONE_RUN = {"eta0.1_step50": (ETA, STEP)}


def _rounded_weights(w):
    return w.withColumn("w", F.round("w", 4))


def _fit(spark, sf_dir, runs):
    data = _data(Tables(spark, sf_dir))
    W = linear.fit_many(data, list(runs.values()), DIM, updates=49, decay=DECAY)
    return data, dict(zip(runs, W))


@query("logistic_fit", _runs_sql(ONE_RUN, 49, _WEIGHTS))
def logistic_fit(spark, sf_dir):
    """Weights after 49 updates (eta 0.1, step 50), long form (run_id, j, w)."""
    _, W = _fit(spark, sf_dir, ONE_RUN)
    return _rounded_weights(linear.weights_frame(spark, W))


@query("logistic_fit_float_steps", _runs_sql(ONE_RUN, 10, _WEIGHTS, decay="exp"))
def logistic_fit_float_steps(spark, sf_dir):
    """Ten updates under the schedule ``eta * exp(-i/step)``."""
    data = _data(Tables(spark, sf_dir))
    W = linear.fit_many(data, list(ONE_RUN.values()), DIM, updates=10, decay="exp")
    return _rounded_weights(linear.weights_frame(spark, dict(zip(ONE_RUN, W))))


@query("coefficients_reloaded", _runs_sql(ONE_RUN, 5, _ACCURACY))
def coefficients_reloaded(spark, sf_dir):
    """Weights of five updates saved as a table, loaded again and scored."""
    data = _data(Tables(spark, sf_dir))
    W = linear.fit_many(data, list(ONE_RUN.values()), DIM, updates=5, decay=DECAY)
    path = save_coefficients(linear.weights_frame(spark, dict(zip(ONE_RUN, W))), scratch_path(spark, "coefficients"))
    rows = load_coefficients(spark, path).orderBy("run_id", "j").collect()
    loaded = {rid: [r["w"] for r in rows if r["run_id"] == rid] for rid in ONE_RUN}
    return linear.score_runs(data, loaded)


@query("logistic_accuracy", _runs_sql(ONE_RUN, 49, _ACCURACY))
def logistic_accuracy(spark, sf_dir):
    data, W = _fit(spark, sf_dir, ONE_RUN)
    return linear.score_runs(data, W)


@query("logistic_sweep", _runs_sql(SWEEP, 49, _ACCURACY))
def logistic_sweep(spark, sf_dir):
    """All six runs trained together (one job per update) and scored in one pass."""
    data, W = _fit(spark, sf_dir, SWEEP)
    return linear.score_runs(data, W)


@query(
    "vector_step",
    "SELECT vec_id, CAST(j AS INTEGER) AS j, ROUND(v - 0.25 * v, 6) AS x FROM "
    "(SELECT vec_id, unnest(range(len(embedding))) AS j, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings)",
)
def vector_step(spark, sf_dir):
    """Every vector moved a quarter of the way to the origin (vector sum and scaling)."""
    x = to_double_array("embedding")
    moved = Tables(spark, sf_dir).embeddings.select("vec_id", F.posexplode(vadd(x, vscale(x, -0.25))).alias("j", "x"))
    return moved.withColumn("x", F.round("x", 6))


_QUAD = """
q AS (SELECT l_orderkey, l_linenumber, ROUND(l_discount * 100 - 5, 6) AS x1, ROUND(l_tax * 100 - 4, 6) AS x2 FROM lineitem)
"""


def _quad_input(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.round(F.col("l_discount") * 100 - 5, 6).alias("x1"),
        F.round(F.col("l_tax") * 100 - 4, 6).alias("x2"),
    )


@query(
    "quadratic_features",
    # "+ 0.0" turns a rounded -0.0 into 0.0 (the engines differ on the sign of a rounded zero).
    f"WITH {_QUAD} SELECT l_orderkey, l_linenumber, x1 + 0.0 AS x1, x2 + 0.0 AS x2, "
    "ROUND(x1 * x1, 6) + 0.0 AS x1_sq, ROUND(x1 * x2, 6) + 0.0 AS x1x2 FROM q",
)
def quadratic_features(spark, sf_dir):
    q = linear.quadratic(_quad_input(Tables(spark, sf_dir)))
    return q.select(
        "l_orderkey", "l_linenumber",
        *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("x1", "x2", "x1_sq", "x1x2")],
    )


@query(
    "margin_score",
    f"""
    WITH {_QUAD}, s AS (SELECT l_orderkey, l_linenumber, (-1.25 + 1.0 * (x1 * x2)) + 0.5 * (x1 * x1) AS f FROM q)
    SELECT l_orderkey, l_linenumber, ROUND(f, 6) AS f, CASE WHEN f > 0 THEN 'A' ELSE 'B' END AS label,
           abs(f) < 1.25 AS in_margin, ROUND(abs(f), 9) = 1.25 AS support
    FROM s
    """,
)
def margin_score(spark, sf_dir):
    q = linear.quadratic(_quad_input(Tables(spark, sf_dir)))
    s = linear.margin_score(q, {"x1x2": 1.0, "x1_sq": 0.5}, bias=-1.25, margin=1.25)
    return s.select("l_orderkey", "l_linenumber", F.round("f", 6).alias("f"), "label", "in_margin", "support")
