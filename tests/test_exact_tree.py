"""Exact trees against a plain recursive tree, grown by levels and in one piece alike."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basalt.operators import exact_tree


def plain(rows, n_features, labels):
    """{path: (counts, feature, threshold)} of the tree on rows (features, label)."""
    out = {}

    def split(part):
        best = None
        for f in range(n_features):
            values = sorted({x[f] for x, _ in part})
            for a, b in zip(values, values[1:]):
                sides = [[y for x, y in part if x[f] <= a], [y for x, y in part if x[f] > a]]
                score = sum(float(sum(s.count(c) ** 2 for c in labels)) / len(s) for s in sides)
                if best is None or score > best[0]:
                    middle = a / 2 + b / 2
                    best = (score, f, a if middle >= b else middle)
        return best

    def visit(path, part):
        counts = [sum(y == c for _, y in part) for c in labels]
        best = split(part) if sum(c > 0 for c in counts) > 1 else None
        out[path] = (counts, best and best[1], best and best[2])
        if best:
            visit(path + "L", [r for r in part if r[0][best[1]] <= best[2]])
            visit(path + "R", [r for r in part if r[0][best[1]] > best[2]])

    visit("", rows)
    return out


def walk(tree, x, labels):
    path = ""
    while tree[path][1] is not None:
        path += "L" if x[tree[path][1]] <= tree[path][2] else "R"
    counts = tree[path][0]
    return labels[counts.index(max(counts))]


def table(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.randrange(12), round(rng.gauss(0, 1), 2), float(rng.randrange(3))
        label = "xyz"[(a > 5) + (b > 0.3)] if rng.random() < 0.8 else rng.choice("xyz")
        rows.append((i, a, b, c, label, rng.choice([0, 1, 2])))
    rows += [(1000 + i, 7, 0.5, 1.0, "xyz"[i % 3], i % 3) for i in range(9)]  # equal rows, every class
    return rows


SCHEMA = "id LONG, a INT, b DOUBLE, c DOUBLE, label STRING, fold INT"


@pytest.mark.parametrize("local_rows, cells", [(50_000, 64), (10, 4), (0, 3)])
def test_equals_a_plain_tree_in_every_fold(spark, local_rows, cells):
    rows = table(3)
    bad = [(2000, None, 1.0, 1.0, "x", 0), (2001, 1, float("nan"), 1.0, "y", 1), (2002, 1, 1.0, 1.0, None, 1), (2003, 1, float("inf"), 0.0, "x", 2)]
    trees = exact_tree.grow(spark.createDataFrame(rows + bad, SCHEMA), ["a", "b", "c"], "label", ["id"], "fold", local_rows=local_rows, cells=cells)
    nodes, held = {}, {}
    for r in trees.nodes.collect():
        nodes.setdefault(r["run"], {})[r["path"]] = (r["counts"], r["feature_index"], r["threshold"])
        assert (r["feature"] is None) == (r["feature_index"] is None) and r["n"] == sum(r["counts"])
    for r in trees.held_out.collect():
        held.setdefault(r["run"], {})[r["id"]] = (r["truth"], r["predicted"])
    for run in (-1, 0, 1, 2):
        want = plain([((a, b, c), y) for _, a, b, c, y, f in rows if f != run], 3, list("xyz"))
        assert nodes[run] == want
        if run >= 0:
            assert held[run] == {i: (y, walk(want, (a, b, c), list("xyz"))) for i, a, b, c, y, f in rows if f == run}
    assert held.get(-1) is None


def test_scores_importances_and_prediction(spark):
    rows = table(5)
    df = spark.createDataFrame(rows, SCHEMA)
    trees = exact_tree.grow(df, ["a", "b", "c"], "label", ["id"], "fold", local_rows=20)
    want = plain([((a, b, c), y) for _, a, b, c, y, _ in rows], 3, list("xyz"))
    weight = dict.fromkeys("abc", 0.0)
    gini = lambda n: 1 - sum((v / sum(n)) ** 2 for v in n)
    for path, (counts, f, _) in want.items():
        if f is not None:
            left, right = want[path + "L"][0], want[path + "R"][0]
            weight["abc"[f]] += sum(counts) * gini(counts) - sum(left) * gini(left) - sum(right) * gini(right)
    got = {r["feature"]: r["importance"] for r in exact_tree.importances(trees).collect()}
    assert got == pytest.approx({f: w / sum(weight.values()) for f, w in weight.items()})
    right = sum(max(c) for c, f, _ in want.values() if f is None)
    assert exact_tree.training_accuracy(trees).first()[0] == pytest.approx(right / len(rows))
    new = spark.createDataFrame([*[(i, a, b + 0.003, c, None, None) for i, a, b, c, _, _ in rows], (5000, None, 1.0, 1.0, None, None)], SCHEMA)
    predicted = {r["id"]: r["predicted_label"] for r in exact_tree.predict(trees, new).collect()}
    assert predicted == {**{i: walk(want, (a, b + 0.003, c), list("xyz")) for i, a, b, c, _, _ in rows}, 5000: None}
    scores = {r["fold"]: r["accuracy"] for r in exact_tree.fold_scores(trees).collect()}
    assert set(scores) == {0, 1, 2} and all(0.3 < s < 1 for s in scores.values())


def test_pure_empty_and_constant_tables(spark):
    def paths(rows, **kw):
        return {(r["run"], r["path"], r["prediction"]) for r in exact_tree.grow(spark.createDataFrame(rows, SCHEMA), ["a", "b"], "label", ["id"], **kw).nodes.collect()}

    assert paths([]) == set()
    assert paths([(1, None, 1.0, 1.0, "x", 0)]) == set()
    assert paths([(i, i, 1.0, 1.0, "x", 0) for i in range(5)]) == {(-1, "", "x")}
    assert paths([(i, 1, 1.0, 1.0, "yx"[i % 2], 0) for i in range(4)], local_rows=0) == {(-1, "", "x")}
    # Both corners of a square: no split gains anything, and the tree still grows pure.
    assert len(paths([(i, i // 2, float(i % 2), 1.0, "xy"[(i // 2 + i) % 2], 0) for i in range(4)])) == 7
    # A single fold: nothing is left to train on.
    got = exact_tree.grow(spark.createDataFrame([(1, 1, 1.0, 1.0, "x", 0)], SCHEMA), ["a"], "label", ["id"], "fold", whole=False)
    assert [tuple(r) for r in got.held_out.collect()] == [(0, 1, "x", None)]
    with pytest.raises(ValueError):
        exact_tree.grow(spark.range(5).select("id", F.col("id").alias("a"), F.col("id").cast("string").alias("label")), ["a"], "label", max_classes=3)


def test_only_lines_of_nodes_are_broadcast(spark, monkeypatch):
    """Rows, values and counts by value reach no driver: every join has a hinted side of a line per large node."""
    df = spark.createDataFrame(table(7, 400), SCHEMA)
    frame, sides = type(df), []
    join = frame.join
    monkeypatch.setattr(frame, "join", lambda self, other, *a, **k: sides.append((other, other._jdf.queryExecution().analyzed().toString())) or join(self, other, *a, **k))
    spark.sparkContext.setJobGroup("grow", "jobs of a growth")
    try:
        trees = exact_tree.grow(df, ["a", "b", "c"], "label", ["id"], "fold", local_rows=60, cells=4)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("grow"))
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    monkeypatch.undo()
    assert sides and all("broadcast" in plan for _, plan in sides)
    large = trees.nodes.where("n > 40").count()
    assert all(side.count() <= 3 * large for side, _ in sides)
    levels = sum("threshold" not in side.columns for side, _ in sides)
    assert levels > 2 and jobs < 20 + 16 * levels


def test_depth_within_a_task():
    """A chain of one-row leaves, a constant feature and rows that no split parts, all in one task."""
    x = np.array([[float(i), 1.0] for i in range(300)] + [[1000.0, 1.0]] * 3)
    y = np.array([i % 2 for i in range(300)] + [0, 1, 1])
    test = np.zeros(len(y), bool)
    test[[10, 302]] = True
    paths, (counts, feature, threshold, left), predicted = exact_tree._grow_here("R", x, y, test, 2)
    want = plain([(tuple(a), int(b)) for a, b, t in zip(x, y, test) if not t], 2, [0, 1])
    got = {p[1:]: (c.tolist(), None if f < 0 else f, None if f < 0 else t) for p, c, f, t in zip(paths, counts, feature, threshold)}
    assert got == want and all(p.startswith("R") for p in paths)
    assert predicted.tolist() == [walk(want, a, [0, 1]) for a in x]
    at = {p: i for i, p in enumerate(paths)}
    assert all((left[i] == counts[at[p + "L"]]).all() for p, i in at.items() if feature[i] >= 0)


def test_comparison_works_its_rows_out_once(spark, tmp_path, monkeypatch):
    from basalt.plans import q_tree

    rng = random.Random(2)
    customers = [(i, i % 5, round(rng.uniform(-900, 9000), 2)) for i in range(60)]
    orders = [(n, rng.randrange(60), rng.uniform(1000, 400000)) for n in range(500)]
    spark.createDataFrame(customers, "c_custkey LONG, c_nationkey INT, c_acctbal DOUBLE").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(orders, "o_orderkey LONG, o_custkey LONG, o_totalprice DOUBLE").write.parquet(f"{tmp_path}/orders.parquet")
    made, features = [], q_tree.customer_features
    monkeypatch.setattr(q_tree, "customer_features", lambda t: made.append(1) or features(t))
    out = q_tree.tree_merged_compare(spark, str(tmp_path))
    rows = out.collect()
    assert len(made) == 1 and {r["run"] for r in rows} == {"original", "merged"} and all(r["train_accuracy"] == 1.0 for r in rows)
    assert "NestedLoopJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_thresholds_between_neighbouring_floats():
    a = 1.0
    b = float(np.nextafter(a, 2))
    assert exact_tree._halfway(a, b) == a and exact_tree._halfway(1.0, 2.0) == 1.5


def test_levels_do_not_copy_the_rows_for_every_run(spark, tmp_path, monkeypatch):
    """Twenty folds: what a level writes holds each row once per feature, in blocks, and not once per run."""
    monkeypatch.setattr(exact_tree, "scratch_path", lambda s, name: f"{tmp_path}/{name}")
    rows = [(*r[:5], r[0] % 20) for r in table(9, 300)]
    trees = exact_tree.grow(spark.createDataFrame(rows, SCHEMA), ["a", "b", "c"], "label", ["id"], "fold", local_rows=100, cells=4)
    at = tmp_path / "exact-tree"
    lines = {d.name: spark.read.parquet(str(d)).count() for d in at.iterdir() if d.name not in ("given", "both", "large", "rows")}
    assert lines and all(n <= 3 * len(rows) for n in lines.values())
    blocks = spark.read.parquet(f"{at}/blocks-0").selectExpr("f", "block", "length(y) / 4 n", "length(at) / 2 pairs").collect()
    assert len(blocks) >= 12 and len({(b["f"], b["block"]) for b in blocks}) == len(blocks) and all(b["pairs"] == 21 * b["n"] for b in blocks)
    assert {f: sum(b["n"] for b in blocks if b["f"] == f) for f in range(3)} == dict.fromkeys(range(3), len(rows))
    nodes = {}
    for r in trees.nodes.collect():
        nodes.setdefault(r["run"], {})[r["path"]] = (r["counts"], r["feature_index"], r["threshold"])
    for run in (-1, 0, 7, 19):
        assert nodes[run] == plain([((a, b, c), y) for _, a, b, c, y, f in rows if f != run], 3, list("xyz"))


def test_rows_of_large_leaves_are_predicted(spark):
    """A node that no value parts, larger than a task takes, with NULL and uneven folds."""
    rows = [(i, 1, -0.0 if i % 2 else 0.0, 1.0, "xxy"[i % 3], None if i % 10 == 0 else i % 2) for i in range(90)] + [(100 + i, 5, 2.0, 1.0, "z", 0) for i in range(3)]
    trees = exact_tree.grow(spark.createDataFrame(rows, SCHEMA), ["a", "b"], "label", ["id"], "fold", whole=False, local_rows=20, cells=3)
    held = {(r["run"], r["id"]): (r["truth"], r["predicted"]) for r in trees.held_out.collect()}
    assert held == {(f, i): (y, "x") for i, _, _, _, y, f in rows if f is not None}
    got = {(r["run"], r["path"]): (r["counts"], r["threshold"]) for r in trees.nodes.collect()}
    trained = [sum(y == c and f != 1 for *_, y, f in rows) for c in "xyz"]
    assert got[(1, "")] == (trained, 3.0) and got[(1, "L")] == ([*trained[:2], 0], None) and set(got) == {(0, ""), (1, ""), (1, "L"), (1, "R")}
