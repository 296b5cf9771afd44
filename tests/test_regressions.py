"""Results that must hold on awkward input: lost or blank lines, NULL and NaN, ragged vectors,
rewritten files, unfinished runs; and nothing may stay cached."""

import types

import pytest
from pyspark.sql import functions as F

from basalt import session
from basalt.operators import clean, cluster, linear, profile, relational, tree
from basalt.plans import all_queries
from basalt.sources import files, tables

SF = "/root/testdata/sf0.001"


def test_grouped_sum_keeps_all_decimals(spark):
    fact = spark.range(1000).select(F.lit(1).alias("k"), F.lit(0.004).alias("q"))
    dim = spark.createDataFrame([(1, "g", 1.0)], "pk INT, g STRING, p DOUBLE")
    assert relational.sum_product_by(fact, dim, "k", "pk", "g", "q", "p").first()["total_value"] == pytest.approx(4.0)
    exact = relational.sum_product_by(fact, dim, "k", "pk", "g", "q", "p", exact_scale=3)
    assert exact.first()["total_value"] == 4.0


def test_blank_line_shifts_no_pair(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "l").mkdir()
    (tmp_path / "m" / "a.txt").write_text("1 1\n2 2\n\n3 3\n")
    (tmp_path / "m" / "b.txt").write_text("   \n4 4\n")
    (tmp_path / "l" / "a.txt").write_text("1\n2\n3\n4\n")
    m, y = files.read_matrix(spark, str(tmp_path / "m"), d=2), files.read_labels(spark, str(tmp_path / "l"))
    got = sorted((r["features"][0], r["y"]) for r in files.align_rows(m, y).collect())
    assert got == [(1.0, 1), (2.0, 2), (3.0, 3), (4.0, 4)]
    short = y.where("line < 3")
    with pytest.raises(Exception, match="row counts differ"):
        files.align_rows(m, short).collect()


def test_line_index_holds_when_splits_change(spark, tmp_path):
    for name, n in (("a", 4000), ("b", 10), ("c", 900)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i:06d}\n" for i in range(n)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "4096")
        lines = files.with_line_index(spark, str(tmp_path))
        spark.conf.set(key, "1000")
        got = [r["value"] for r in lines.orderBy("line").collect()]
        assert [r["line"] for r in lines.select("line").orderBy("line").collect()] == list(range(4910))
    finally:
        spark.conf.set(key, before)
    assert got == [f"{name}{i:06d}" for name, n in (("a", 4000), ("b", 10), ("c", 900)) for i in range(n)]


def test_csv_with_a_bad_cell_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\nx,3\n")
    with pytest.raises(Exception):
        files.read_csv_table(spark, str(tmp_path / "x.csv"), "a INT, b INT").collect()
    assert files.read_csv_table(spark, str(tmp_path / "x.csv"), "a INT, b INT", mode="PERMISSIVE").count() == 2


def test_majority_ignores_null_as_a_class(spark):
    df = spark.createDataFrame([(None,)] * 6 + [("a",)] * 3 + [("b",)], "y STRING")
    assert profile.majority_accuracy(df, "y").first()["majority_pct"] == 30.0
    assert profile.majority_accuracy(df.where("y is null"), "y").first()["majority_pct"] == 0.0


def test_correlation_skips_nan(spark):
    rows = [(float(i), 2.0 * i) for i in range(5)] + [(float("nan"), 1.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE")
    assert profile.correlation_pairs(df, ["a", "b"]).first()["r"] == pytest.approx(1.0)


def test_confusion_matrix_counts_null_rows(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), (None, "b"), ("b", "b")], "y STRING, p STRING")
    got = {(r["truth"], r["predicted"]): r["count"] for r in tree.confusion_matrix(df, "y", "p").collect()}
    assert len(got) == 9 and sum(got.values()) == 4 and got[("a", None)] == 1 and got[(None, "b")] == 1


def test_ragged_vectors_fail(spark):
    df = spark.createDataFrame([(1, [9.0], 1)], "id LONG, features ARRAY<DOUBLE>, y INT")
    for bad in (
        cluster.assign(df, [[0.0, 0.0], [1.0, 1.0]]),
        cluster.distance_matrix(df, [[0.0, 0.0]], "id"),
        linear.gradients(df, [[0.0, 0.0]]),
        linear.score_runs(df, {"r": [0.0, 0.0]}),
    ):
        with pytest.raises(Exception, match="vector width is not 2"):
            bad.collect()


def test_kmeans_limits_and_reruns(spark, tmp_path):
    df = spark.createDataFrame([(i, [float(i % 7), float(i // 7)]) for i in range(40)], "id LONG, features ARRAY<DOUBLE>")
    start = [[0.0, 0.0], [1.0, 0.0], [2.0, 0.0]]
    with pytest.raises(RuntimeError):
        cluster.kmeans(df, start, tol=0.0, max_iter=1)
    assert not cluster.kmeans(df, start, tol=0.0, max_iter=1, partial=True).converged
    out = str(tmp_path / "a")
    for _ in range(2):
        res = cluster.kmeans(df, start, tol=0.01, id_col="id", assignments_path=out)
    assert {r["count"] for r in spark.read.parquet(out).groupBy("iteration").count().collect()} == {40}
    assert res.converged and res.assignments.count() == 40


def test_rewritten_file_gives_fresh_codes(spark, tmp_path):
    path = str(tmp_path / "labels")
    spark.createDataFrame([("b",), ("c",)], "l STRING").write.parquet(path)
    assert {(r["l"], r["code"]) for r in clean.label_encode(spark.read.parquet(path), "l").collect()} == {("b", 0), ("c", 1)}
    spark.createDataFrame([("a",), ("b",), ("c",)], "l STRING").write.mode("overwrite").parquet(path)
    got = {(r["l"], r["code"]) for r in clean.label_encode(spark.read.parquet(path), "l").collect()}
    assert got == {("a", 0), ("b", 1), ("c", 2)}


@pytest.mark.parametrize("name", ["label_encode", "customer_features", "top_customers_products", "kmeans_fit", "describe_numeric", "tree_cv"])
def test_queries_leave_nothing_cached(spark, name):
    spark.catalog.clearCache()
    all_queries()[name](spark, SF).collect()
    assert not len(spark.sparkContext._jsc.getPersistentRDDs())


def test_catalog_report_of_missing_and_empty_database(spark, tmp_path):
    assert tables.catalog_row_counts(spark, "no_such_database").count() == 0
    spark.sql(f"CREATE DATABASE IF NOT EXISTS empty_db LOCATION '{tmp_path}'")
    assert tables.catalog_row_counts(spark, "empty_db").count() == 0


def test_cluster_without_shared_folder_is_refused():
    none = types.SimpleNamespace(isDefined=lambda: False)
    context = types.SimpleNamespace(master="spark://host:7077", _jsc=types.SimpleNamespace(sc=lambda: types.SimpleNamespace(getCheckpointDir=lambda: none)))
    fake = types.SimpleNamespace(sparkContext=context, conf=types.SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(fake, "x")


def test_reports_come_in_order(spark):
    q = all_queries()
    names = [r["table_name"] for r in q["table_row_counts"](spark, SF).collect()]
    assert names == sorted(names)
    totals = [r["total_value"] for r in q["revenue_by_product_line"](spark, SF).collect()]
    assert totals == sorted(totals, reverse=True)
    nodes = [r["node"] for r in q["out_degree"](spark, SF).collect()]
    assert nodes == sorted(nodes)
    keys = [r["o_orderkey"] for r in q["preview_rows"](spark, SF).collect()]
    assert keys == sorted(keys) and len(keys) == 50
