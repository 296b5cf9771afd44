"""Iterative and ML queries have no SQL oracle; check them against brute force on small fixtures."""

import math

import numpy as np
import pytest

from basalt.operators import cluster, linear, tree
from basalt.sinks import files as sinks


def _np_logistic(X, y, runs, updates, decay):
    out = []
    for eta, step in runs:
        w = np.zeros(X.shape[1])
        for i in range(1, updates + 1):
            p = 1 / (1 + np.exp(-(X @ w)))
            g = X.T @ (y - p)
            w = w + linear.learning_rate(eta, step, i, decay) * g
        out.append(w)
    return out


@pytest.mark.parametrize("decay", ["staircase", "exp"])
def test_fit_many_matches_numpy(spark, decay):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(120, 6))
    y = (X[:, 0] + 0.5 * X[:, 1] + rng.normal(scale=0.5, size=120) > 0).astype(int)
    df = spark.createDataFrame([(X[i].tolist(), int(y[i])) for i in range(120)], "features ARRAY<DOUBLE>, y INT")
    runs = [(0.1, 50), (0.5, 5), (1.0, 3)]
    got = linear.fit_many(df, runs, 6, updates=12, decay=decay)
    want = _np_logistic(X, y, runs, 12, decay)
    for g, w in zip(got, want):
        assert g == pytest.approx(w.tolist(), rel=1e-9, abs=1e-9)
    acc = {r["run_id"]: r["accuracy"] for r in linear.score_runs(df, {"a": got[0], "b": got[1]}).collect()}
    for rid, w in (("a", want[0]), ("b", want[1])):
        p = 1 / (1 + np.exp(-(X @ w)))
        assert acc[rid] == pytest.approx(float(np.mean((p >= 0.5).astype(int) == y)))


def _np_kmeans(P, C, tol, max_iter):
    C = [np.array(c, dtype=float) for c in C]
    hist = []
    for it in range(1, max_iter + 1):
        d = np.array([[np.sum((p - c) ** 2) for c in C] for p in P])
        a = d.argmin(axis=1)  # first minimum: lowest id on ties
        new, unconv = [], 0
        for cid, c in enumerate(C):
            m = P[a == cid]
            if len(m):
                nc = m.mean(axis=0)
                unconv += math.sqrt(np.sum((nc - c) ** 2)) > tol
                new.append(nc)
        hist.append(unconv)
        C = new
        if unconv == 0:
            return C, hist, a
    return C, hist, a


def test_kmeans_matches_numpy(spark):
    rng = np.random.default_rng(3)
    centers = np.array([[0, 0, 0], [5, 5, 5], [0, 8, 2], [9, 0, 4]], dtype=float)
    P = np.vstack([c + rng.normal(size=(60, 3)) for c in centers])
    df = spark.createDataFrame([(i, P[i].tolist()) for i in range(len(P))], "id LONG, features ARRAY<DOUBLE>")
    start = [P[i].tolist() for i in range(4)]
    res = cluster.kmeans(df, start, tol=0.01, max_iter=50)
    C, hist, a = _np_kmeans(P, start, 0.01, 50)
    assert [h[1] for h in res.history] == hist
    assert len(res.centroids) == len(C)
    for g, w in zip(res.centroids, C):
        assert g == pytest.approx(w.tolist())
    got = {r["id"]: r["cluster_id"] for r in res.assignments.select("id", "cluster_id").collect()}
    assert [got[i] for i in range(len(P))] == a.tolist()


def test_tree_cv_and_importances(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        a, b = float(rng.uniform(0, 10)), float(rng.uniform(0, 10))
        rows.append((i, a, b, "hi" if a > 5 else "lo"))
    df = spark.createDataFrame(rows, "id LONG, a DOUBLE, b DOUBLE, cls STRING")
    folded = tree.assign_folds(df, "cls", ["id"], 4).cache()
    scores = tree.cross_validate(folded, ["a", "b"], "cls", max_depth=5, max_bins=64)
    assert scores.count() == 4
    assert min(r["accuracy"] for r in scores.collect()) > 0.9
    model = tree.fit_tree(df, ["a", "b"], "cls", max_depth=5, max_bins=64)
    imp = {r["feature"]: r["importance"] for r in tree.importances(model, ["a", "b"]).collect()}
    assert sum(imp.values()) == pytest.approx(1.0) and imp["a"] > 0.9
    nodes = tree.tree_nodes(model, ["a", "b"]).collect()
    assert nodes[0]["feature"] == "a"
    ml = tree.cross_validate_ml(folded, ["a", "b"], "cls", max_depth=5, max_bins=64).first()
    assert ml["mean"] == pytest.approx(np.mean([r["accuracy"] for r in scores.collect()]), abs=1e-9)
    s = tree.score_summary(scores).first()
    acc = [r["accuracy"] for r in scores.collect()]
    assert s["mean"] == pytest.approx(np.mean(acc)) and s["plus_minus"] == pytest.approx(2 * np.std(acc))


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, [2, 3]), (2, [1])], "node LONG, neighbors ARRAY<LONG>")
    p = sinks.write_tuple_text(df.orderBy("node"), str(tmp_path / "adj"), ["node", "neighbors"])
    lines = sorted(r["value"] for r in spark.read.text(p).collect())
    assert lines == ["(1, [2, 3])", "(2, [1])"]
    w = linear.weights_frame(spark, {"r1": [0.5, -1.0]})
    q = sinks.save_coefficients(w, str(tmp_path / "coef"))
    back = sorted(tuple(r) for r in sinks.load_coefficients(spark, q).collect())
    assert back == [("r1", 0, 0.5), ("r1", 1, -1.0)]
    part = sinks.write_result(spark.createDataFrame([(1, "a"), (2, "b")], "iteration INT, v STRING"), str(tmp_path / "hist"), partition_by=["iteration"])
    assert spark.read.parquet(part).count() == 2
