"""Hard negatives against a loop over all pairs, on awkward rows, and the work that bounds save."""

import numpy as np
from basalt.llm.hard_negatives import Block, mine, spanning_tree, window_of, windows_wanted
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label int, uid string, block int, place string, v long, anchor string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, "u", 1, "p", 2, "a") for i, v, c in rows], SCHEMA)


def brute(rows, every, positives=5, negatives=3, scale=256):
    ok = [(i, [int(np.floor(scale * x)) for x in v], c) for i, v, c in rows if i is not None and c is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, v, c) in enumerate(ok):
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, d) for b, (j, w, d) in enumerate(ok) if b != a and len(w) == len(v))
        for s, j, _ in [x for x in scored if x[2] == c][:positives]:
            fits = [x for x in scored if x[2] != c and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fits)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_equals_all_pairs_on_awkward_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0.1, 0.3, 6).tolist(), int(rng.integers(0, 3))) for i in range(160)]
    rows += [(i, rows[i][1], rows[i][2]) for i in range(0, 40, 3)]  # repeated rows
    rows += [(200 + i, rows[7][1], i % 3) for i in range(20)]  # one vector under every label: ties
    rows += [(None, [0.1] * 6, 1), (300, None, 1), (310, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1), (320, [float("nan")] * 6, 1), (330, [float("inf")] * 6, 2), (340, [], 0), (350, [0.2] * 6, None)]
    rows += [(360, [0.5, 0.5], 0), (370, [0.5, 0.4], 0), (371, [0.4, 0.3], 1), (380, [0.0] * 6, 1), (-10, rng.normal(0, 1, 6).tolist(), 2)]
    want = brute(rows, 10)
    assert want
    for sizes in ({}, {"block_rows": 16, "anchor_rows": 4}):
        assert got(mine(frame(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"), **sizes)) == want


def test_without_rows_anchors_or_labels(spark):
    for rows in ([], [(1, [1.0], 1)], [(10, [1.0], 1)], [(10, [1.0], None), (11, None, 2)], [(10, [1.0], 1), (11, [1.0], 1)]):
        out = mine(frame(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"))
        assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and out.count() == 0


def test_huge_components_stay_exact(spark):
    rows = [(10 * i, [float(2**29 + i), -(2.0**28) + 3 * i], i % 2) for i in range(8)]
    assert got(mine(frame(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"), scale=1.0)) == brute(rows, 10, scale=1)


def test_windows_are_whole_numbers():
    for p in range(-300, 300):
        least, most = window_of(p, (50, 100), (95, 100))
        assert [s for s in range(-700, 700) if 50 * p <= 100 * s <= 95 * p] == list(range(least, most + 1))


def test_spanning_tree_is_minimal():
    v = np.random.default_rng(5).integers(-50, 50, (30, 4))
    order, parent, length = spanning_tree(v)
    seen = set()
    for a in order:
        assert parent[a] in seen or parent[a] == -1 and not seen
        seen.add(a)
    edges = sorted((float(np.sqrt(((v[a] - v[b]) ** 2).sum())), a, b) for a in range(30) for b in range(a))
    root, total = list(range(30)), 0.0
    for d, a, b in edges:  # by joining the nearest pairs
        if root[a] != root[b]:
            total, root = total + d, [root[a] if x == root[b] else x for x in root]
    assert abs(length.sum() - total) < 1e-6


def test_bounds_spare_candidates_near_a_parent():
    rng = np.random.default_rng(8)
    centre = rng.normal(0, 100, (1, 32))
    anchors = np.rint(centre + rng.normal(0, 1, (40, 32))).astype(np.int64)
    block = Block(np.rint(rng.normal(0, 100, (1000, 32))).astype(np.int64))
    order, parent, length = spanning_tree(anchors)
    place = np.argsort(order)
    tree = (anchors[order], np.where(parent < 0, -1, place[parent])[order], length[order])
    truth = tree[0] @ block.whole.T
    window = [(int(np.quantile(truth, 0.90)), int(np.quantile(truth, 0.95)))]
    every = np.ones(1000, bool)
    for a, rows, scores in block.walk(*tree, lambda a, low, high: windows_wanted(low, high, every, window, 3)):
        assert (scores == truth[a, rows]).all()
        inside = lambda s: sorted(x for x in s if window[0][0] <= x <= window[0][1])[-3:]
        assert inside(scores) == inside(truth[a])
    assert block.rescored < 0.5 * truth.size
