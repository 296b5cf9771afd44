"""Property tests: operators against brute force on random small inputs."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basalt.operators import graph, profile, tree
from basalt.operators.ordering import cumulative_weights, positional_index

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

edges_st = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=40)


@SETTINGS
@given(edges=edges_st)
def test_reciprocal_pairs_brute_force(spark, edges):
    e = spark.createDataFrame(edges, "src LONG, dst LONG")
    got = {tuple(r) for r in graph.reciprocal_pairs(e).collect()}
    s = set(edges)
    want = {(min(a, b), max(a, b)) for a, b in s if (b, a) in s}
    assert got == want
    adj = graph.reciprocal_adjacency(e, form="long").collect()
    by_node = {}
    for r in adj:
        by_node.setdefault(r["node"], []).append((r["pos"], r["neighbor"]))
    for node, items in by_node.items():
        items.sort()
        assert [p for p, _ in items] == list(range(len(items)))
        assert [n for _, n in items] == sorted({b for a, b in s if a == node and (b, a) in s})


@SETTINGS
@given(vals=st.lists(st.integers(-3, 3), min_size=1, max_size=60))
def test_positions_and_cumulative_counts(spark, vals):
    rows = [(v, i) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "v LONG, i LONG")
    pos = {r["i"]: r["pos"] for r in positional_index(df, ["v", "i"]).collect()}
    order = sorted(rows)
    assert [pos[i] for _, i in order] == list(range(len(rows)))
    counts = df.groupBy("v").count().withColumnRenamed("count", "c")
    cum = {r["v"]: r["cum"] for r in cumulative_weights(counts, ["v"], "c").collect()}
    for v in set(vals):
        assert cum[v] == sum(1 for x in vals if x < v)


@SETTINGS
@given(vals=st.lists(st.sampled_from([0.0, 0.5, 1.0, 2.0, 7.25]), min_size=1, max_size=60),
       q=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_quantiles_with_duplicates(spark, vals, q):
    df = spark.createDataFrame([(v,) for v in vals], "a DOUBLE")
    got = {r["q"]: r["value"] for r in profile.exact_quantiles(df, ["a"], [q]).collect()}
    assert got[q] == pytest.approx(float(np.quantile(np.array(vals), q)))


@SETTINGS
@given(labels=st.lists(st.sampled_from(["a", "b", "c"]), min_size=4, max_size=60), k=st.integers(2, 4))
def test_stratified_folds_balanced(spark, labels, k):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(labels)], "id LONG, cls STRING")
    rows = tree.assign_folds(df, "cls", ["id"], k).collect()
    assert sorted(r["id"] for r in rows) == list(range(len(labels)))
    for c in set(labels):
        n = labels.count(c)
        sizes = [sum(1 for r in rows if r["cls"] == c and r["fold"] == f) for f in range(k)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n
