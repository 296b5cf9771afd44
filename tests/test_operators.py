"""Unit tests of single operators on small literal frames (NULLs, ties, skew, empty input)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basalt.operators import clean, cluster, graph, linear, many_centroids, profile, relational, tree
from basalt.operators.ordering import cumulative_within, positional_index, rank_within
from basalt.sources import files, tables


def test_positional_index_is_contiguous_under_skew(spark):
    # One key holds most rows: positions must still be 0..n-1 in order, spread over tasks.
    rows = [(0 if i % 3 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k LONG, v LONG")
    out = positional_index(df, ["k", "v"]).orderBy("pos").collect()
    assert [r["pos"] for r in out] == list(range(3000))
    assert [(r["k"], r["v"]) for r in out] == sorted(rows)


def test_rank_within_groups(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 5), ("a", 2), (None, 7), (None, 6)], "g STRING, v INT")
    got = {(r["g"], r["v"]): r["rank"] for r in rank_within(df, ["g"], ["v"], with_size="n").collect()}
    assert got == {("a", 1): 0, ("a", 2): 1, ("a", 3): 2, ("b", 5): 0, (None, 6): 0, (None, 7): 1}


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=501), rng.integers(0, 10, size=501).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a DOUBLE, b DOUBLE")
    q = {(r["column"], r["q"]): r["value"] for r in profile.exact_quantiles(df, ["a", "b"]).collect()}
    for col, arr in (("a", a), ("b", b)):
        for p in (0.25, 0.5, 0.75):
            assert q[(col, p)] == pytest.approx(float(np.quantile(arr, p)))


def test_group_quantile_median(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("x", 10.0), ("x", 4.0), ("y", 3.0)], "g STRING, v DOUBLE")
    got = {r["g"]: r["median"] for r in profile.group_quantile(df, ["g"], "v").collect()}
    assert got == {"x": 3.0, "y": 3.0}


def test_describe_approx_option(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "a DOUBLE")
    r = profile.describe_numeric(df, ["a"], exact=False).first()
    assert r["count"] == 101 and r["min"] == 0.0 and r["max"] == 100.0 and r["p50"] == 50.0


def test_null_and_negative_counts(spark):
    df = spark.createDataFrame([(1, -1.0, "a"), (None, float("nan"), None), (3, 2.0, "c")], "i INT, d DOUBLE, s STRING")
    n = {r["column"]: (r["n_null"], r["has_null"]) for r in profile.null_counts(df).collect()}
    assert n == {"i": (1, True), "d": (1, True), "s": (1, True)}
    neg = {r["column"]: r["n_negative"] for r in profile.negative_counts(df).collect()}
    assert neg == {"i": 0, "d": 1}


def test_key_uniqueness_counts_null_key_once(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (None,)], "k INT")
    r = profile.key_uniqueness(df, ["k"]).first()
    assert (r["n_rows"], r["n_distinct_keys"], r["is_unique"]) == (4, 3, False)


def test_parse_number_lenient_and_strict(spark):
    df = spark.createDataFrame([("12%",), ("bad",), (None,)], "p STRING")
    assert [r["p"] for r in clean.parse_number(df, ["p"]).collect()] == [12.0, None, None]
    assert clean.parse_failures(df, ["p"]).first()["n_bad"] == 1
    with pytest.raises(Exception):
        clean.parse_number(df, ["p"], strict=True).collect()
    cur = spark.createDataFrame([("$1,200",)], "c STRING")
    assert clean.parse_number(cur, ["c"], strip="$").first()["c"] is None
    assert clean.parse_number(cur, ["c"], strip="$,").first()["c"] == 1200.0


def test_drop_value_keeps_nulls(spark):
    df = spark.createDataFrame([(0.0,), (None,), (1.0,)], "u DOUBLE")
    assert sorted([r["u"] for r in clean.drop_value(df, "u", 0.0).collect()], key=lambda v: (v is None, v)) == [1.0, None]


def test_merge_and_encode(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "l STRING")
    m = [r["l"] for r in clean.merge_categories(df, "l", {"c": "Other"}).collect()]
    assert m == ["b", "a", "Other", "a", None]
    t = [r["l"] for r in clean.merge_tail(df, "l", min_count=2).collect()]
    assert sorted(map(str, t)) == ["None", "Other", "Other", "a", "a"]
    enc = clean.label_encode(df, "l")
    codes = {r["l"]: r["code"] for r in enc.collect()}
    assert codes == {"a": 0, "b": 1, "c": 2, None: None}
    dec = clean.label_decode(enc.where(F.col("code").isNotNull()).select("code"), "code", clean.label_codes(df, "l"), "l")
    assert sorted(r["l"] for r in dec.collect()) == ["a", "a", "b", "c"]


def test_relational_helpers(spark):
    df = spark.createDataFrame([("Pat", "smith"), ("ann", "Poe"), ("bob", "stone")], "first STRING, last STRING")
    assert relational.name_prefix_count(df, ["first", "last"], "p").first()["n"] == 2
    got = [tuple(r) for r in relational.initial_counts(df, "last").collect()]
    assert got == [("S", 2)]
    d = spark.createDataFrame([("2020-01-31", "2020-02-01"), ("2020-03-01", "2020-02-01"), ("2020-01-05", None)], "due STRING, done STRING")
    # true day differences: -1 (late) and 29; NULL drops out.
    assert relational.slack_days_count(d, "due", "done", 2).first()["n"] == 1


def test_folds_partition_and_balance(spark):
    rows = [(i, "big" if i % 10 else "small") for i in range(400)]
    df = spark.createDataFrame(rows, "id LONG, cls STRING")
    f = tree.assign_folds(df, "cls", ["id"], 4)
    assert f.count() == 400
    counts = {(r["cls"], r["fold"]): r["count"] for r in f.groupBy("cls", "fold").count().collect()}
    assert counts == {("big", i): 90 for i in range(4)} | {("small", i): 10 for i in range(4)}


def test_confusion_matrix_fills_zeros(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "y STRING, p STRING")
    got = [tuple(r) for r in tree.confusion_matrix(df, "y", "p").collect()]
    assert got == [("a", "a", 1), ("a", "b", 1), ("b", "a", 0), ("b", "b", 1)]


def test_edge_and_vector_text_sources(spark, tmp_path):
    p = tmp_path / "edges"
    p.mkdir()
    (p / "a.txt").write_text("1\t2\t5\n2\t1\t3\n")
    e = files.read_edges(spark, str(p))
    assert sorted(tuple(r) for r in e.collect()) == [(1, 2, 5), (2, 1, 3)]
    w = tmp_path / "ws.txt"
    w.write_text("1  2 9\n 3\t4\n")
    assert sorted(tuple(r) for r in files.read_edges_whitespace(spark, str(w)).collect()) == [(1, 2), (3, 4)]
    v = tmp_path / "vecs"
    v.mkdir()
    (v / "part-0.txt").write_text("1.0, 2.0\n3.0 4.0\n")
    (v / "part-1.txt").write_text("5,6\n" * 50)
    got = files.read_vectors(spark, str(v), d=2).orderBy("line").collect()
    assert [r["line"] for r in got] == list(range(52))
    assert list(got[0]["features"]) == [1.0, 2.0] and list(got[1]["features"]) == [3.0, 4.0]
    bad = tmp_path / "bad.txt"
    bad.write_text("1 2\n1 2 3\n")
    with pytest.raises(Exception):
        files.read_vectors(spark, str(bad), d=2).collect()


def test_table_row_counts_and_catalog(spark):
    a = spark.range(3).toDF("x")
    b = spark.range(5).toDF("x")
    got = [tuple(r) for r in tables.table_row_counts({"b": b, "a": a}).collect()]
    assert got == [("a", 3), ("b", 5)]
    assert tables.database_exists(spark, "default")
    assert not tables.database_exists(spark, "no_such_db_x")


def test_correlation_methods_agree(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=200)
    b = a * 0.7 + rng.normal(size=200) * 0.3
    c = rng.normal(size=200)
    df = spark.createDataFrame([(float(x), float(y), float(z)) for x, y, z in zip(a, b, c)], "a DOUBLE, b DOUBLE, c DOUBLE")
    p1 = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_pairs(df, ["a", "b", "c"]).collect()}
    p2 = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_pairs(df, ["a", "b", "c"], method="gram").collect()}
    assert p1 == pytest.approx(p2)
    assert p1[("a", "b")] == pytest.approx(float(np.corrcoef(a, b)[0, 1]))


def test_confusion_wide(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "y STRING, p STRING")
    wide = [tuple(r) for r in tree.confusion_wide(tree.confusion_matrix(df, "y", "p")).collect()]
    assert wide == [("a", 1, 1), ("b", 0, 1)]


def test_quantiles_with_a_hot_value(spark):
    # A third of the rows share one value; quantiles still match numpy.
    rng = np.random.default_rng(4)
    vals = np.concatenate([np.full(300, 2.5), rng.normal(size=600), np.arange(10.0)])
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(vals)], "a DOUBLE, g INT")
    q = {(r["column"], r["q"]): r["value"] for r in profile.exact_quantiles(df, ["a"], (0.1, 0.5, 0.9)).collect()}
    for p in (0.1, 0.5, 0.9):
        assert q[("a", p)] == pytest.approx(float(np.quantile(vals, p)))
    med = {r["g"]: r["median"] for r in profile.group_quantile(df, ["g"], "a").collect()}
    for g in range(3):
        assert med[g] == pytest.approx(float(np.median(vals[np.arange(len(vals)) % 3 == g])))


def test_describe_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "a DOUBLE")
    r = profile.describe_numeric(df, ["a"]).first()
    assert (r["count"], r["mean"], r["min"], r["max"], r["p50"]) == (2, 2.0, 1.0, 3.0, 2.0)


def test_sum_product_by(spark):
    fact = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 1.5), (3, 4.0), (3, 0.25)], "k LONG, q DOUBLE")
    dim = spark.createDataFrame([(1, "a", 10.0), (2, "b", 2.5), (3, "a", 1.1)], "pk LONG, g STRING, p DOUBLE")
    got = [tuple(r) for r in relational.sum_product_by(fact, dim, "k", "pk", "g", "q", "p").collect()]
    assert got == [("a", 54.675), ("b", 3.75)]


def test_one_missing_element_takes_out_its_row_only(spark):
    # 101 rows in 2 tasks: 50 x 10.0, 50 x 20.0 and one bad row.
    for bad in (float("nan"), None, float("inf")):
        rows = [(i, [10.0 if i < 50 else 20.0], 1.0) for i in range(100)] + [(100, [bad], 1.0)]
        df = spark.createDataFrame(rows, "id LONG, x ARRAY<DOUBLE>, y DOUBLE").repartition(2)
        sums = cluster.centroid_sums(df.withColumn("cluster_id", F.lit(0)), "x").first()
        assert (sums["coord"], sums["n"]) == (15.0, 100)
        assert linear.gradient(df, [0.0], "x").first()["g"] == 750.0
        assert tuple(cluster.left_out(df, "x").first()) == (101, 1)
        assigned = cluster.assign(df, [[0.0], [20.0]], "x").where("id = 100").first()
        assert assigned["cluster_id"] is None and assigned["d2"] is None
        assert cluster.distance_matrix(df, [[0.0], [20.0]], "id", "x").where("id = 100").count() == 0
        assert cluster.kmeans(df, [[9.0], [21.0]], "x").centroids == [[10.0], [20.0]]
    missing = spark.createDataFrame([(0, None, 1.0), (1, [2.0], None), (2, [4.0], float("nan")), (3, [6.0], 1.0)], "id LONG, x ARRAY<DOUBLE>, y DOUBLE")
    assert linear.gradient(missing, [0.0], "x").first()["g"] == 3.0
    assert cluster.centroid_sums(missing.withColumn("cluster_id", F.lit(0)), "x").first()["coord"] == 4.0


def test_sums_beyond_64_bits(spark):
    e = spark.createDataFrame([(1, 2, 2**63 - 1), (3, 2, 2**63 - 1)], "src LONG, dst LONG, weight LONG")
    assert int(graph.in_weight(e).first()["in_weight"]) == 2 * (2**63 - 1)


def test_confusion_wide_with_missing_labels(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), (None, "b")], "y STRING, p STRING")
    wide = tree.confusion_wide(tree.confusion_matrix(df, "y", "p"))
    assert wide.columns == ["truth", "a", "b", "NULL"]
    assert [tuple(r) for r in wide.collect()] == [("a", 1, 0, 1), ("b", 0, 0, 0), (None, 0, 1, 0)]
    with pytest.raises(ValueError):
        tree.confusion_wide(tree.confusion_matrix(df, "y", "p"), max_labels=2)


def test_report_skips_temp_views_and_quotes_names(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("some_view")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS odd_db LOCATION '{tmp_path}'")
    spark.range(4).write.mode("overwrite").saveAsTable("odd_db.odd_table")
    assert [tuple(r) for r in tables.catalog_row_counts(spark, "odd_db").collect()] == [("odd_table", 4)]
    spark.sql("DROP DATABASE odd_db CASCADE")


def test_ranks_of_groups_that_span_partitions(spark):
    # One group over nearly all partitions, NULL and NaN groups, and many small ones.
    rows = [(2.0, i) for i in range(500)] + [(None, i) for i in range(70)] + [(float("nan"), i) for i in range(60)] + [(10.0 + i % 7, i) for i in range(100)]
    df = spark.createDataFrame(rows, "g DOUBLE, v INT").repartition(7)
    out = rank_within(df, ["g"], ["v"], with_size="n").collect()
    seen = {}
    for g, v in sorted(rows, key=lambda r: r[1]):
        key = repr(g)
        seen.setdefault(key, []).append(v)
    assert sorted((repr(r["g"]), r["v"], r["rank"], r["n"]) for r in out) == sorted((k, v, i, len(vs)) for k, vs in seen.items() for i, v in enumerate(vs))
    weighted = spark.createDataFrame([("a", i, 3) for i in range(200)] + [("b", 0, 5), ("b", 1, 1)], "g STRING, v INT, w INT")
    got = {(r["g"], r["v"]): (r["cum"], r["size"]) for r in cumulative_within(weighted, ["g"], ["v"], "w").collect()}
    assert got == {**{("a", i): (3 * i, 600) for i in range(200)}, ("b", 0): (0, 6), ("b", 1): (5, 6)}
    assert rank_within(df.limit(0), ["g"], ["v"]).count() == 0


def test_adjacency_chunks_join_to_the_sorted_list(spark):
    edges = [(1, i) for i in range(2, 40)] + [(i, 1) for i in range(2, 40)] + [(50, 50)]
    df = spark.createDataFrame(edges, "src LONG, dst LONG")
    chunks = graph.reciprocal_adjacency(df, form="chunks", chunk=5).collect()
    assert all(len(r["neighbors"]) <= 5 for r in chunks)
    joined = {}
    for r in sorted(chunks, key=lambda r: (r["node"], r["chunk"])):
        joined.setdefault(r["node"], []).extend(r["neighbors"])
    assert joined == {r["node"]: list(r["neighbors"]) for r in graph.reciprocal_adjacency(df, form="list").collect()}


def test_quarantine_keeps_bad_rows_with_file_and_line(spark, tmp_path):
    folder = tmp_path / "e"
    folder.mkdir()
    (folder / "a.txt").write_text("1\t2\t3\n\n1\t2\n1\tx\t3\n")
    (folder / "b.txt").write_text("4\t5\t6\n1\t2\t9223372036854775808\n")
    q = files.quarantine_edges(spark, str(folder))
    assert [tuple(r) for r in q.good.orderBy("src").collect()] == [(1, 2, 3), (4, 5, 6)]
    bad = sorted((r["file"].rsplit("/", 1)[1], r["line"], r["reason"], r["value"]) for r in q.bad.collect())
    assert bad == [("a.txt", 1, "2 fields, not 3", "1\t2"), ("a.txt", 2, "dst is no whole number", "1\tx\t3"), ("b.txt", 1, "weight is no whole number", "1\t2\t9223372036854775808")]
    assert sorted(tuple(r) for r in q.counts().collect()) == [("2 fields, not 3", 1), ("dst is no whole number", 1), ("good", 2), ("weight is no whole number", 1)]
    (tmp_path / "c.csv").write_text("id,p\n1,2.5\n2,\nx,1\n3,4,5\n4\n")
    q = files.quarantine_csv(spark, str(tmp_path / "c.csv"), "id LONG, p DOUBLE")
    assert sorted((r["id"], r["p"]) for r in q.good.collect()) == [(1, 2.5), (2, None), (4, None)]
    assert sorted(r["reason"] for r in q.bad.collect()) == ["id is no bigint", "more than 2 fields"]
    (tmp_path / "v.txt").write_text("1 2\n3\n4 five\n6,7\n")
    q = files.quarantine_vectors(spark, str(tmp_path / "v.txt"), d=2)
    assert sorted((r["line"], list(r["features"])) for r in q.good.collect()) == [(0, [1.0, 2.0]), (3, [6.0, 7.0])]
    assert sorted((r["line"], r["reason"]) for r in q.bad.collect()) == [(1, "1 fields, not 2"), (2, "not a number")]


def test_many_centroids_assign_as_the_literal_ones(spark):
    rng = np.random.default_rng(3)
    points = np.round(rng.normal(size=(300, 6)), 1)  # coarse, so that distances tie
    centroids = np.vstack([points[:40], points[:5], np.round(rng.normal(size=(20, 6)), 1)])
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6)]
    df = spark.createDataFrame(rows, "id LONG, x ARRAY<DOUBLE>")
    want = {r["id"]: (r["cluster_id"], r["d2"]) for r in cluster.assign(df, centroids.tolist(), "x").collect()}
    for max_bytes in (1 << 20, 6 * 8 * 10):  # one table, and one in seven parts
        got = {r["id"]: (r["cluster_id"], r["d2"]) for r in many_centroids.assign_many(df, centroids, "x", max_bytes=max_bytes).collect()}
        assert got == want
    with pytest.raises(Exception):
        many_centroids.assign_many(spark.createDataFrame([(1, [1.0])], "id LONG, x ARRAY<DOUBLE>"), centroids, "x").collect()


def test_thousands_of_centroids_need_no_literal(spark):
    rng = np.random.default_rng(4)
    centroids = rng.normal(size=(5000, 784))
    df = spark.createDataFrame([(i, centroids[i * 7].tolist()) for i in range(20)], "id LONG, x ARRAY<DOUBLE>")
    out = many_centroids.assign_many(df, centroids, "x")
    assert len(out._jdf.queryExecution().toString()) < 20_000
    assert {r["id"]: r["cluster_id"] for r in out.select("id", "cluster_id").collect()} == {i: i * 7 for i in range(20)}


def test_bounds_spare_distances_and_change_no_cluster(spark):
    rng = np.random.default_rng(5)
    points = np.vstack([rng.normal(c, 0.4, size=(150, 3)) for c in (0, 4, 8, 12)])
    df = spark.createDataFrame([(p.tolist(),) for p in points] + [(None,), ([1.0, None, 2.0],)], "x ARRAY<DOUBLE>")
    start = np.vstack([points[[0, 1, 2, 200]], [[100.0] * 3]])  # the last one gets no point
    plain = cluster.kmeans(df, start.tolist(), "x", tol=1e-6)
    bounded = many_centroids.kmeans_many(df, start, "x", tol=1e-6)
    assert bounded.history == plain.history
    assert np.allclose(bounded.centroids, plain.centroids, atol=1e-9)
    assert bounded.distances[0] == 600 and bounded.distances[-1] < 300


def test_stored_counts_go_stale(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS stats_db LOCATION '{tmp_path}'")
    spark.range(5).write.mode("overwrite").saveAsTable("stats_db.a")
    spark.range(3).write.mode("overwrite").saveAsTable("stats_db.b")
    assert [tuple(r) for r in tables.stored_row_counts(spark, "stats_db").collect()] == [("a", None), ("b", None)]
    tables.analyze_tables(spark, "stats_db")
    stored = tables.stored_row_counts(spark, "stats_db")
    assert [tuple(r) for r in stored.collect()] == [("a", 5), ("b", 3)]
    assert "Scan parquet" not in stored._jdf.queryExecution().toString()
    spark.range(2).write.mode("append").parquet(f"{tmp_path}/b")
    spark.catalog.refreshTable("stats_db.b")
    assert [tuple(r) for r in tables.stored_row_counts(spark, "stats_db", check=True).collect()] == [("a", 5, 5, False), ("b", 3, 5, True)]
    assert tables.stored_row_counts(spark, "no_such_db").count() == 0
    spark.sql("DROP DATABASE stats_db CASCADE")


def test_gram_correlations_skip_missing_pairs(spark):
    rng = np.random.default_rng(6)
    values = rng.normal(1e6, 1.0, size=(400, 5))
    values[:, 1] += values[:, 0]
    rows = [[None if rng.random() < 0.1 else float("nan") if rng.random() < 0.05 else float(v) for v in r] for r in values]
    df = spark.createDataFrame([(*r, 7.0) for r in rows], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, e DOUBLE, flat DOUBLE")
    want = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_pairs(df, df.columns[:5]).collect()}
    got = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_pairs(df.repartition(5), df.columns, method="gram").collect()}
    assert len(got) == 15 and all(got[k] is None if "flat" in k else got[k] == pytest.approx(want[k], abs=1e-6) for k in got)


@pytest.mark.parametrize("group_rows", [100_000, 5, 0])
def test_group_quantile_of_small_and_large_groups(spark, group_rows):
    """Groups are ranked in a task or over tasks, by their size; both ways give the same, NULL group and repeated values included."""
    rng = np.random.default_rng(6)
    rows = [(g, None if g is None else g % 2, float(v)) for g, n in ((None, 9), (1, 1), (2, 4), (3, 6), (4, 30)) for v in rng.integers(-3, 3, n)]
    df = spark.createDataFrame([*rows, (5, 1, None), (5, 1, float("nan")), (2, 0, None)], "g INT, k INT, v DOUBLE")
    for q in (0.3, 0.5):
        got = {(r["g"], r["k"]): r["m"] for r in profile.group_quantile(df, ["g", "k"], "v", q, "m", group_rows=group_rows).collect()}
        keys = {(g, k) for g, k, _ in rows}
        assert got == pytest.approx({k: float(np.quantile([v for *key, v in rows if tuple(key) == k], q)) for k in keys})
