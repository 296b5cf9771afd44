"""Registered queries: per-customer features, folds, evaluation tables and decision trees.

Stand-in for the housing table: one row per customer with order count, exact median
order total and account balance; the class ``tier`` is 'few' (< 5 orders), else by
median total: 'low' (< 180k), 'mid' (< 260k), 'high'.
A fixed threshold rule on orders (priority predicted from total price) gives a
deterministic prediction for the evaluation tables.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from basalt.operators import clean, exact_tree, profile, tree
from basalt.operators import relational as rel
from basalt.plans.registry import Tables, query
from basalt.session import scratch_path
from basalt.sinks.models import load_model, save_model

# Bands with fewer distinct values than a tree has bins, the class borders on band borders: a
# tree grown until its leaves are pure then repeats the class of every training row.
FEATURES = ["n_orders", "total_band", "acct_band"]
K_FOLDS = 4
MERGED_FOLDS = 10

_FEAT_SQL = """
f AS (SELECT o_custkey, COUNT(*) AS n_orders, QUANTILE_CONT(o_totalprice, 0.5) AS median_total FROM orders GROUP BY o_custkey),
feat AS (SELECT c_custkey, n_orders, median_total, c_acctbal,
                CASE WHEN n_orders < 5 THEN 'few' WHEN median_total < 180000 THEN 'low'
                     WHEN median_total < 260000 THEN 'mid' ELSE 'high' END AS tier
         FROM f JOIN customer ON o_custkey = c_custkey)
"""


def customer_features(t: Tables):
    o = t.orders.select("o_custkey", "o_totalprice")
    counts = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    med = profile.group_quantile(o, ["o_custkey"], "o_totalprice", 0.5, name="median_total")
    f = counts.join(med, "o_custkey").join(t.customer.select("c_custkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
    tier = (
        F.when(F.col("n_orders") < 5, "few")
        .when(F.col("median_total") < 180000, "low")
        .when(F.col("median_total") < 260000, "mid")
        .otherwise("high")
    )
    return f.select("c_custkey", "n_orders", "median_total", "c_acctbal", tier.alias("tier"))


@query(
    "customer_features",
    f"WITH {_FEAT_SQL} SELECT c_custkey, n_orders, ROUND(median_total, 6) AS median_total, c_acctbal, tier FROM feat",
)
def customer_features_q(spark, sf_dir):
    return customer_features(Tables(spark, sf_dir)).withColumn("median_total", F.round("median_total", 6))


@query(
    "stratified_folds",
    f"""
    WITH {_FEAT_SQL}, c AS (SELECT tier, COUNT(*) AS n FROM feat GROUP BY tier)
    SELECT tier, CAST(r AS INTEGER) AS fold, (n - r + {K_FOLDS - 1}) // {K_FOLDS} AS count
    FROM c, range({K_FOLDS}) t(r) WHERE (n - r + {K_FOLDS - 1}) // {K_FOLDS} > 0
    """,
)
def stratified_folds(spark, sf_dir):
    f = tree.assign_folds(customer_features(Tables(spark, sf_dir)), "tier", ["c_custkey"], K_FOLDS)
    return f.groupBy("tier", "fold").agg(F.count(F.lit(1)).alias("count"))


@query("shuffled_rows", "SELECT *, md5('42|' || CAST(o_orderkey AS VARCHAR)) AS shuffle_key FROM orders")
def shuffled_rows(spark, sf_dir):
    """Orders in a reproducible random order (seeded hash of the key)."""
    return rel.shuffled(Tables(spark, sf_dir).orders, ["o_orderkey"], seed=42)


_RULE_SQL = """
p AS (SELECT o_orderkey, o_orderpriority AS truth,
             CASE WHEN o_totalprice < 50000 THEN '1-URGENT' WHEN o_totalprice < 100000 THEN '2-HIGH'
                  WHEN o_totalprice < 200000 THEN '3-MEDIUM' WHEN o_totalprice < 300000 THEN '4-NOT SPECIFIED'
                  ELSE '5-LOW' END AS predicted
      FROM orders)
"""


def _rule(t: Tables):
    price = F.col("o_totalprice")
    pred = (
        F.when(price < 50000, "1-URGENT")
        .when(price < 100000, "2-HIGH")
        .when(price < 200000, "3-MEDIUM")
        .when(price < 300000, "4-NOT SPECIFIED")
        .otherwise("5-LOW")
    )
    return t.orders.select("o_orderkey", F.col("o_orderpriority").alias("truth"), pred.alias("predicted"))


@query(
    "confusion_matrix",
    f"""
    WITH {_RULE_SQL},
    q AS (SELECT nullif(truth, '2-HIGH') AS truth, nullif(predicted, '5-LOW') AS predicted FROM p),
    l AS (SELECT truth AS l FROM q UNION SELECT predicted FROM q),
    c AS (SELECT truth, predicted, COUNT(*) AS count FROM q GROUP BY truth, predicted)
    SELECT a.l AS truth, b.l AS predicted, COALESCE(c.count, 0) AS count
    FROM l a CROSS JOIN l b LEFT JOIN c ON c.truth IS NOT DISTINCT FROM a.l AND c.predicted IS NOT DISTINCT FROM b.l
    """,
)
def confusion_matrix(spark, sf_dir):
    """Some true and some predicted labels are missing; every row is counted."""
    r = _rule(Tables(spark, sf_dir))
    r = r.select(F.nullif("truth", F.lit("2-HIGH")).alias("truth"), F.nullif("predicted", F.lit("5-LOW")).alias("predicted"))
    return tree.confusion_matrix(r, "truth", "predicted")


@query(
    "cv_summary",
    f"""
    WITH {_RULE_SQL},
    s AS (SELECT o_orderkey % {K_FOLDS} AS fold, AVG(CAST(truth = predicted AS DOUBLE)) AS accuracy FROM p GROUP BY fold)
    SELECT ROUND(AVG(accuracy), 6) AS mean, ROUND(2 * STDDEV_POP(accuracy), 6) AS plus_minus FROM s
    """,
)
def cv_summary(spark, sf_dir):
    """Fold scores of the fixed rule (folds by key modulo k) summarised as mean ± 2·std."""
    p = _rule(Tables(spark, sf_dir)).withColumn("fold", F.pmod("o_orderkey", F.lit(K_FOLDS)))
    scores = p.groupBy("fold").agg(F.avg((F.col("truth") == F.col("predicted")).cast("double")).alias("accuracy"))
    s = tree.score_summary(scores)
    return s.select(F.round("mean", 6).alias("mean"), F.round("plus_minus", 6).alias("plus_minus"))


def _banded(t: Tables):
    f = customer_features(t)
    return f.select("c_custkey", "n_orders", F.floor(F.col("median_total") / 20000).alias("total_band"), F.floor(F.col("c_acctbal") / 1000).alias("acct_band"), "tier")


def _fit(spark, sf_dir):
    feats = _banded(Tables(spark, sf_dir))
    return feats, tree.fit_tree(feats, FEATURES, "tier")


@query("tree_fit_predict", f"WITH {_FEAT_SQL} SELECT c_custkey, tier, tier AS predicted_label FROM feat")
def tree_fit_predict(spark, sf_dir):
    feats, model = _fit(spark, sf_dir)
    return model.transform(feats).select("c_custkey", "tier", "predicted_label")


@query("tree_reloaded_predict", f"WITH {_FEAT_SQL} SELECT c_custkey, tier, tier AS predicted_label FROM feat")
def tree_reloaded_predict(spark, sf_dir):
    """Predictions of a model that was saved twice (the second replaces the first) and read back."""
    feats, model = _fit(spark, sf_dir)
    path = scratch_path(spark, "tree-model")
    for _ in range(2):
        save_model(spark, model, path)
    return load_model(path).transform(feats).select("c_custkey", "tier", "predicted_label")


# Raw features that do not settle the class: trees go deep, and unseen rows are often wrong.
RAW = ["n_orders", "c_acctbal", "c_nationkey"]


def _raw(t: Tables):
    nation = t.customer.select(F.col("c_custkey").alias("_key"), "c_nationkey")
    f = customer_features(t)
    return f.join(nation, F.col("c_custkey") == F.col("_key")).select("c_custkey", *RAW, "tier")


def _merged(df):
    return clean.merge_categories(df, "tier", {"few": "Other", "low": "Other"})


def _folded(df, k: int):
    """Folds by key, so that the oracle has the same ones."""
    return df.withColumn("fold", F.pmod("c_custkey", F.lit(k)).cast("int"))


def _tree_sql(k: int, merged: bool = False, whole: bool = True) -> str:
    """The trees as a recursive query over (run, row, path): each step finds every node's best split
    by window functions over its training rows and sends all its rows on."""
    classes = ["Other", "high", "mid"] if merged else ["few", "high", "low", "mid"]
    tier = "CASE WHEN tier IN ('few', 'low') THEN 'Other' ELSE tier END" if merged else "tier"
    runs = [*range(k), *([-1] if whole else [])]
    n = range(len(classes))
    below = ", ".join(f"count(CASE WHEN NOT test AND y = {c} THEN 1 END) OVER (PARTITION BY run, path, f ORDER BY v) AS l{c}" for c in n)
    all_ = ", ".join(f"count(CASE WHEN NOT test AND y = {c} THEN 1 END) OVER (PARTITION BY run, path, f) AS t{c}" for c in n)
    nl, nr = " + ".join(f"l{c}" for c in n), " + ".join(f"(t{c} - l{c})" for c in n)
    sl, sr = " + ".join(f"l{c} * l{c}" for c in n), " + ".join(f"(t{c} - l{c}) * (t{c} - l{c})" for c in n)
    kinds = " + ".join(f"(t{c} > 0)::INTEGER" for c in n)
    return f"""
    WITH RECURSIVE {_FEAT_SQL},
    base AS (SELECT feat.c_custkey AS id, list_position({classes}, {tier}) - 1 AS y, [n_orders::DOUBLE, feat.c_acctbal::DOUBLE, c_nationkey::DOUBLE] AS x
             FROM feat JOIN customer ON customer.c_custkey = feat.c_custkey),
    t(run, id, test, y, x, path, pf, pt) AS (
        SELECT r.run, id, id % {k} = r.run, y, x, '', NULL::INTEGER, NULL::DOUBLE FROM base, (SELECT unnest({runs}) AS run) r
        UNION ALL
        SELECT run, id, test, y, x, path || CASE WHEN x[bf + 1] <= bt THEN 'L' ELSE 'R' END, bf, bt FROM (
            SELECT run, id, test, y, x, path, f, first_value(f) OVER b AS bf, first_value(thr) OVER b AS bt, first_value(ok) OVER b AS bok FROM (
                SELECT *, NOT test AND ({kinds}) > 1 AND ({nr}) > 0 AS ok,
                       CASE WHEN NOT test AND ({kinds}) > 1 AND ({nr}) > 0 THEN ({sl})::DOUBLE / ({nl}) + ({sr})::DOUBLE / ({nr}) ELSE -1 END AS score,
                       CASE WHEN v / 2 + up / 2 >= up THEN v ELSE v / 2 + up / 2 END AS thr
                FROM (SELECT *, {below}, {all_},
                             min(CASE WHEN NOT test THEN v END) OVER (PARTITION BY run, path, f ORDER BY v GROUPS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS up
                      FROM (SELECT run, id, test, y, x, path, unnest(range(3))::INTEGER AS f, unnest(x) AS v FROM t)))
            WINDOW b AS (PARTITION BY run, path ORDER BY ok DESC, score DESC, f, v ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
        WHERE bok AND f = 0),
    node AS (SELECT run, path, {", ".join(f"count(CASE WHEN NOT test AND y = {c} THEN 1 END) AS t{c}" for c in n)} FROM t GROUP BY run, path),
    rule AS (SELECT DISTINCT run, path[:-2] AS path, pf, pt FROM t WHERE path <> ''),
    shape AS (SELECT node.*, pf, pt, {" + ".join(f"t{c}" for c in n)} AS n FROM node LEFT JOIN rule ON rule.run = node.run AND rule.path = node.path),
    named AS (SELECT *, list_position([{", ".join(f"t{c}" for c in n)}], greatest({", ".join(f"t{c}" for c in n)})) - 1 AS top,
                     1 - ({" + ".join(f"(t{c} / n) * (t{c} / n)" for c in n)}) AS gini FROM shape),
    gain AS (SELECT p.*, p.gini - l.n / p.n * l.gini - r.n / p.n * r.gini AS gain
             FROM named p LEFT JOIN named l ON l.run = p.run AND l.path = p.path || 'L' LEFT JOIN named r ON r.run = p.run AND r.path = p.path || 'R'),
    leaf AS (SELECT run, id, y, arg_max(path, length(path)) AS path FROM t WHERE test GROUP BY run, id, y),
    score AS (SELECT leaf.run AS fold, AVG((leaf.y = named.top)::INTEGER) AS accuracy FROM leaf JOIN named ON named.run = leaf.run AND named.path = leaf.path GROUP BY leaf.run),
    fit AS (SELECT sum(greatest({", ".join(f"t{c}" for c in n)})) / sum(n) AS train_accuracy FROM named WHERE run = -1 AND pf IS NULL),
    names AS (SELECT {classes} AS labels, {RAW} AS features)
    """


def _grown(rows, k: int, merged: bool = False, folds: bool = True, whole: bool = True):
    rows = _folded(_merged(rows) if merged else rows, k)
    return exact_tree.grow(rows, RAW, "tier", ["c_custkey"], "fold" if folds else None, whole=whole)


@query(
    "tree_importances",
    _tree_sql(1)
    + """SELECT f.feature, ROUND(COALESCE(SUM(n * gain) / (SELECT SUM(n * gain) FROM gain WHERE run = -1 AND pf IS NOT NULL), 0), 6) AS importance
    FROM (SELECT unnest(features) AS feature, unnest(range(3)) AS i FROM names) f LEFT JOIN gain ON gain.run = -1 AND gain.pf = f.i GROUP BY f.feature""",
)
def tree_importances(spark, sf_dir):
    trees = _grown(_raw(Tables(spark, sf_dir)), 1, folds=False)
    return exact_tree.importances(trees).withColumn("importance", F.round("importance", 6))


@query(
    "tree_nodes",
    _tree_sql(1)
    + """SELECT path, n, labels[top + 1] AS prediction, ROUND(gini, 6) AS impurity, ROUND(gain, 6) AS gain, features[pf + 1] AS feature, ROUND(pt, 6) AS threshold
    FROM gain, names WHERE run = -1""",
)
def tree_nodes(spark, sf_dir):
    """The tree on all rows, parents right before their subtrees."""
    nodes = _grown(_raw(Tables(spark, sf_dir)), 1, folds=False).nodes
    rounded = [F.round(c, 6).alias(c) for c in ("impurity", "gain", "threshold")]
    return nodes.select("path", "n", "prediction", rounded[0], rounded[1], "feature", rounded[2]).orderBy("path")


@query("tree_cv", _tree_sql(K_FOLDS, whole=False) + "SELECT fold, ROUND(accuracy, 6) AS accuracy FROM score")
def tree_cv(spark, sf_dir):
    """Accuracy per fold (4 folds) on rows that the fold's tree has not seen."""
    return exact_tree.fold_scores(_grown(_raw(Tables(spark, sf_dir)), K_FOLDS, whole=False)).withColumn("accuracy", F.round("accuracy", 6))


_COMPARE = """SELECT '{run}' AS run, ROUND(AVG(accuracy), 6) AS mean, ROUND(2 * STDDEV_POP(accuracy), 6) AS plus_minus, ROUND(ANY_VALUE(train_accuracy), 6) AS train_accuracy FROM score, fit"""


@query(
    "tree_merged_compare",
    f"""SELECT * FROM ({_tree_sql(K_FOLDS)} {_COMPARE.format(run="original")})
    UNION ALL SELECT * FROM ({_tree_sql(K_FOLDS, merged=True)} {_COMPARE.format(run="merged")})""",
)
def tree_merged_compare(spark, sf_dir):
    """CV summary and training accuracy before and after merging two tiers."""
    rows, path = _raw(Tables(spark, sf_dir)), scratch_path(spark, "tree-rows")
    rows.write.parquet(path)  # both times the same rows
    rows = spark.read.schema(rows.schema).parquet(path)
    columns = ("mean", "plus_minus", "train_accuracy")

    def summary(run: str):
        trees = _grown(rows, K_FOLDS, run == "merged")
        parts = tree.score_summary(exact_tree.fold_scores(trees)).unionByName(exact_tree.training_accuracy(trees), allowMissingColumns=True)  # one row each
        return parts.agg(*[F.round(F.max(c), 6).alias(c) for c in columns]).select(F.lit(run).alias("run"), *columns)

    with ThreadPoolExecutor(2) as pool:  # the small jobs of one fill the gaps of the other
        original, merged = pool.map(summary, ("original", "merged"))
    return original.unionByName(merged)


@query("tree_merged_cv10", _tree_sql(MERGED_FOLDS, merged=True, whole=False) + "SELECT fold, ROUND(accuracy, 6) AS accuracy FROM score")
def tree_merged_cv10(spark, sf_dir):
    """Accuracy of each of 10 folds on the merged tiers, all folds grown together."""
    return exact_tree.fold_scores(_grown(_raw(Tables(spark, sf_dir)), MERGED_FOLDS, merged=True, whole=False)).withColumn("accuracy", F.round("accuracy", 6))
