"""Golden values from the exercises (k-means worksheet, margin scoring, own graph case)."""

import math

import pytest
from pyspark.sql import functions as F

from basalt.operators import cluster, graph, linear

# The eight worksheet points and the first centroid set.
POINTS = [("A1", 2, 10), ("A2", 2, 5), ("A3", 8, 4), ("B1", 5, 8), ("B2", 7, 5), ("B3", 6, 4), ("C1", 1, 2), ("C2", 4, 9)]
START = [[2.0, 10.0], [5.0, 8.0], [1.0, 2.0]]


@pytest.fixture()
def points(spark):
    rows = [(n, [float(x), float(y)]) for n, x, y in POINTS]
    return spark.createDataFrame(rows, "name STRING, features ARRAY<DOUBLE>")


def _assign(points, cents):
    rows = cluster.assign(points, cents).select("name", "cluster_id").collect()
    return {r["name"]: r["cluster_id"] for r in rows}


def test_worksheet_assignments_and_updates(points):
    expected = [
        ([[2, 10], [5, 8], [1, 2]], [0, 2, 1, 1, 1, 1, 2, 1], [[2, 10], [6, 6], [1.5, 3.5]]),
        ([[2, 10], [6, 6], [1.5, 3.5]], [0, 2, 1, 1, 1, 1, 2, 0], [[3, 9.5], [6.5, 5.25], [1.5, 3.5]]),
        ([[3, 9.5], [6.5, 5.25], [1.5, 3.5]], [0, 2, 1, 0, 1, 1, 2, 0], [[11 / 3, 9], [7, 13 / 3], [1.5, 3.5]]),
    ]
    for cents, assign_exp, upd_exp in expected:
        cents = [[float(v) for v in c] for c in cents]
        got = _assign(points, cents)
        assert [got[n] for n, _, _ in POINTS] == assign_exp
        new, _ = cluster.update(cluster.assign(points, cents), 3, 2)
        for cid, c in enumerate(upd_exp):
            assert new[cid] == pytest.approx(c)


def test_worksheet_distances(points):
    dm = cluster.distance_matrix(points, START, "name").collect()
    d = {(r["name"], r["cluster_id"]): r["distance"] for r in dm}
    assert [d[("A2", i)] for i in range(3)] == pytest.approx([5.0, math.sqrt(18), math.sqrt(10)])
    assert [d[("C2", i)] for i in range(3)] == pytest.approx([math.sqrt(5), math.sqrt(2), math.sqrt(58)])


def test_kmeans_default_start_drops_empty_cluster(points):
    res = cluster.kmeans(points, cluster.initial_centroids(3, 2), tol=0.1, empty="drop")
    assert [h[1] for h in res.history] == [2, 2, 0]
    got = sorted(res.centroids)
    assert got[0] == pytest.approx([1.5, 3.5])
    assert got[1] == pytest.approx([16 / 3, 20 / 3])
    assert res.converged


def test_kmeans_history_outputs(spark, points, tmp_path):
    out = str(tmp_path / "assign")
    res = cluster.kmeans(points, START, tol=0.1, id_col="name", assignments_path=out)
    assert [h[0] for h in res.history] == [1, 2, 3, 4]
    per_iter = {r["iteration"]: r["count"] for r in spark.read.parquet(out).groupBy("iteration").count().collect()}
    assert per_iter == {1: 8, 2: 8, 3: 8, 4: 8}
    hist = cluster.centroid_history_frame(spark, res).where("iteration = 1").orderBy("cluster_id").collect()
    assert [list(r["coords"]) for r in hist] == [[2.0, 10.0], [6.0, 6.0], [1.5, 3.5]]
    assert hist[1]["shift"] == pytest.approx(2.2360679775)


def test_kmeans_keep_empty_cluster(points):
    res = cluster.kmeans(points, cluster.initial_centroids(3, 2), tol=0.1, empty="keep")
    assert len(res.centroids) == 3


def test_kmeans_sse_never_rises(points):
    cents = START
    prev = None
    for _ in range(4):
        a = cluster.assign(points, cents)
        sse = a.agg(F.sum("d2")).first()[0]
        if prev is not None:
            assert sse <= prev + 1e-9
        prev = sse
        new, _ = cluster.update(a, len(cents), 2)
        cents = [new[i] for i in sorted(new)]


def test_initial_centroids_df(spark):
    rows = cluster.initial_centroids_df(spark, 3, 2).orderBy("cluster_id").collect()
    assert [list(r["coords"]) for r in rows] == [[1.0, 1.0], [2.0, 2.0], [3.0, 3.0]]


def test_assign_tie_goes_to_lowest_id(spark):
    p = spark.createDataFrame([("p", [1.0, 2.0])], "name STRING, features ARRAY<DOUBLE>")
    assert _assign(p, [[1.0, 1.0], [1.0, 3.0]])["p"] == 0


def test_margin_scoring_support_rows(spark):
    # The eight-row separable set (x1, x2, class).
    rows = [(2, 2, "A"), (-2, -1, "A"), (1, 2, "A"), (2, 1, "A"), (-2, 2, "B"), (0, 2, "B"), (0, -1, "B"), (2, -1, "B")]
    df = spark.createDataFrame([(i, float(a), float(b), c) for i, (a, b, c) in enumerate(rows)], "i INT, x1 DOUBLE, x2 DOUBLE, cls STRING")
    s = linear.margin_score(linear.quadratic(df), {"x1x2": 1.0, "x1_sq": 0.5}, bias=-1.25, margin=1.25).orderBy("i").collect()
    assert [r["f"] for r in s] == pytest.approx([4.75, 2.75, 1.25, 2.75, -3.25, -1.25, -1.25, -1.25])
    assert [r["i"] for r in s if r["support"]] == [2, 5, 6, 7]
    assert all(r["label"] == r["cls"] for r in s)


def test_own_graph_case(spark):
    e = spark.createDataFrame([(1, 2, 5), (2, 1, 3), (2, 1, 4), (3, 3, 1), (1, 3, 2)], "src LONG, dst LONG, weight LONG")
    assert [tuple(r) for r in graph.out_degree(e).collect()] == [(1, 2), (2, 2), (3, 1)]
    assert [tuple(r) for r in graph.in_weight(e).collect()] == [(1, 7), (2, 5), (3, 3)]
    lst = graph.reciprocal_adjacency(e, form="list").collect()
    assert [(r["node"], list(r["neighbors"])) for r in lst] == [(1, [2]), (2, [1]), (3, [3])]
    long = graph.reciprocal_adjacency(e, form="long").orderBy("node", "pos").collect()
    assert [(r["node"], r["pos"], r["neighbor"]) for r in long] == [(1, 0, 2), (2, 0, 1), (3, 0, 3)]


def test_reciprocal_pairs_invariant_under_relabel(spark):
    edges = [(1, 2), (2, 1), (2, 3), (3, 4), (4, 3), (5, 5), (6, 7)]
    e = spark.createDataFrame(edges, "src LONG, dst LONG")
    r = spark.createDataFrame([(a * 10 + 1, b * 10 + 1) for a, b in edges], "src LONG, dst LONG")
    p1 = {tuple(x) for x in graph.reciprocal_pairs(e).collect()}
    p2 = {((u - 1) // 10, (v - 1) // 10) for u, v in graph.reciprocal_pairs(r).collect()}
    assert p1 == p2 == {(1, 2), (3, 4), (5, 5)}


def test_learning_rate_staircase_matches_integer_division():
    # Python 2 `-i/step` with ints floors, i.e. -ceil(i/step).
    assert linear.learning_rate(0.1, 50, 1) == pytest.approx(0.1 * math.exp(-1))
    assert linear.learning_rate(0.1, 50, 49) == pytest.approx(0.1 * math.exp(-1))
    assert linear.learning_rate(1.0, 3, 4) == pytest.approx(math.exp(-2))
    assert linear.learning_rate(1.0, 3, 4, decay="exp") == pytest.approx(math.exp(-4 / 3))


def test_logistic_gradient_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    X = rng.normal(size=(40, 5))
    y = (rng.random(40) > 0.5).astype(int)
    w = rng.normal(size=5) * 0.1
    df = spark.createDataFrame([(X[i].tolist(), int(y[i])) for i in range(40)], "features ARRAY<DOUBLE>, y INT")
    g = {r["j"]: r["g"] for r in linear.gradient(df, w.tolist()).collect()}
    p = 1 / (1 + np.exp(-(X @ w)))
    expect = X.T @ (y - p)
    assert [g[j] for j in range(5)] == pytest.approx(expect.tolist())


def test_minmax_grid_constant_weights(spark):
    w = spark.createDataFrame([(j, 1.0) for j in range(4)], "j INT, w DOUBLE")
    rows = linear.minmax_grid(w, width=2).collect()
    assert {r["pixel"] for r in rows} == {0.0}
    assert {(r["row"], r["col"]) for r in rows} == {(0, 0), (0, 1), (1, 0), (1, 1)}
