"""Decision-tree classification with MLlib, stratified folds, cross-validation and
evaluation tables (confusion matrix, score summary, importances, node table).

Training is MLlib's distributed tree learner (per-node split statistics aggregated
across executors). Folds are assigned by a seeded hash inside each class and balanced
with a distributed rank (a big class is not moved into one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.operators.ordering import rank_within


def assign_folds(df: DataFrame, label: str, key: Sequence[str], k: int, seed: int = 42, stratified: bool = True, name: str = "fold") -> DataFrame:
    """Add ``name`` in 0..k-1.

    Stratified: inside each class, rows are ordered by a seeded hash of ``key`` and dealt
    round-robin, so every fold gets ``floor`` or ``ceil`` of n_class / k rows of each class.
    Otherwise: ``pmod(xxhash64(seed, key), k)``.
    """
    h = F.xxhash64(F.lit(seed), *key)
    if not stratified:
        return df.withColumn(name, F.pmod(h, F.lit(k)).cast("int"))
    ranked = rank_within(df.withColumn("_h", h), [label], ["_h", *key], name="_r")
    return ranked.withColumn(name, (F.col("_r") % k).cast("int")).drop("_h", "_r")


MAX_DEPTH = 30  # the deepest tree that MLlib grows; reached only if leaves are still mixed


def tree_pipeline(features: Sequence[str], label: str, max_depth: int = MAX_DEPTH, max_bins: int = 256, seed: int = 42) -> Pipeline:
    """Assemble features, index labels in sorted order (codes 0..m-1), fit a gini tree,
    and decode predictions back to label text (``predicted_label``).

    Leaves grow until they are pure, or to ``max_depth``; a feature with more than ``max_bins``
    distinct values is split at that many quantiles."""
    indexer = StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc")
    assembler = VectorAssembler(inputCols=list(features), outputCol="features_vec")
    return Pipeline(stages=[indexer, assembler, _classifier(max_depth, max_bins, seed), _decoder(indexer)])


def _classifier(max_depth: int = MAX_DEPTH, max_bins: int = 256, seed: int = 42) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        featuresCol="features_vec", labelCol="label_idx", impurity="gini", maxDepth=max_depth, maxBins=max_bins, seed=seed
    )


def _decoder(indexer: StringIndexer) -> IndexToString:
    return IndexToString(inputCol="prediction", outputCol="predicted_label")


def fit_tree(df: DataFrame, features: Sequence[str], label: str, **kw) -> PipelineModel:
    """Fit the pipeline. The training input is read several times (label indexer, split
    sampling, tree-point conversion, one pass per tree level), so its used columns are
    persisted meanwhile."""
    pipe = tree_pipeline(features, label, **kw)
    train = df.select(*features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = pipe.fit(train)
    finally:
        train.unpersist()
    # IndexToString needs the label list of the fitted indexer.
    model.stages[3].setLabels(model.stages[0].labels)
    return model


def tree_of(model: PipelineModel) -> DecisionTreeClassificationModel:
    return model.stages[2]


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def accuracy(pred: DataFrame, truth: str = "label_idx", pred_col: str = "prediction", name: str = "accuracy") -> DataFrame:
    return pred.agg(F.avg((F.col(truth) == F.col(pred_col)).cast("double")).alias(name))


def cross_validate(df: DataFrame, features: Sequence[str], label: str, fold: str = "fold", parallelism: int = 1, **kw) -> DataFrame:
    """Per-fold accuracy ``(fold, accuracy)``: train on the other folds, test on this one. Rows
    without a label take no part. :mod:`basalt.operators.exact_tree` grows all folds at once.

    Folds are independent; ``parallelism > 1`` fits that many at the same time
    (concurrent Spark jobs from driver threads), which pays off when each fit leaves
    executors idle. Measured locally it did not, so the default is sequential.
    """
    from concurrent.futures import ThreadPoolExecutor

    spark = df.sparkSession
    df = df.where(F.col(label).isNotNull())
    indexer = StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc")
    assembler = VectorAssembler(inputCols=list(features), outputCol="features_vec")
    # Index and assemble once; every fold then trains on the same cached vectors.
    ready = assembler.transform(indexer.fit(df).transform(df)).select("features_vec", "label_idx", F.col(fold).alias("_fold"))
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)

    def one(f):
        model = _classifier(**kw).fit(ready.where(F.col("_fold") != f))
        scored = model.transform(ready.where(F.col("_fold") == f))
        return int(f), float(scored.agg(F.avg((F.col("label_idx") == F.col("prediction")).cast("double"))).first()[0])

    try:
        folds = sorted(r[0] for r in ready.select("_fold").distinct().collect())
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(folds)))) as pool:
            out = list(pool.map(one, folds))
    finally:
        ready.unpersist()
    return spark.createDataFrame(out, "fold INT, accuracy DOUBLE")


def score_summary(scores: DataFrame, col: str = "accuracy") -> DataFrame:
    """``mean`` and ``plus_minus`` = 2 × population std of the fold scores."""
    return scores.agg(F.avg(col).alias("mean"), (2 * F.stddev_pop(col)).alias("plus_minus"))


def confusion_matrix(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Long form ``(truth, predicted, count)`` over the full label grid (zeros included).

    Labels are the values of either column; NULL is one of them if it occurs, so every row is
    counted. The grid comes from the sparse counts: each truth label gets the array of all
    labels, and counts are joined to it null-safely.
    """
    counts = df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("count"))
    ends = counts.select(F.explode(F.array(F.struct(F.col("truth").alias("l")), F.struct(F.col("predicted").alias("l")))).alias("s")).select("s.l").distinct()
    every = ends.agg(F.collect_list(F.struct("l")).alias("all"))
    grid = every.select(F.explode("all").alias("t"), "all").select(F.col("t.l").alias("t"), F.explode("all").alias("p")).select("t", F.col("p.l").alias("p"))
    joined = grid.join(counts, F.col("t").eqNullSafe(F.col("truth")) & F.col("p").eqNullSafe(F.col("predicted")), "left")
    return joined.select(F.col("t").alias("truth"), F.col("p").alias("predicted"), F.coalesce("count", F.lit(0)).cast("long").alias("count")).orderBy("truth", "predicted")


def importances(model: PipelineModel | DecisionTreeClassificationModel, features: Sequence[str]) -> DataFrame:
    """``(feature, importance)``; importances sum to 1."""
    tree = tree_of(model) if isinstance(model, PipelineModel) else model
    vals = tree.featureImportances.toArray().tolist()
    spark = _spark_of(tree)
    return spark.createDataFrame(list(zip(features, map(float, vals))), "feature STRING, importance DOUBLE")


def tree_nodes(model: PipelineModel | DecisionTreeClassificationModel, features: Sequence[str]) -> DataFrame:
    """The fitted tree as a node table in pre-order (the exported picture of the tree, as
    data): children are node ids, -1 at leaves."""
    tree = tree_of(model) if isinstance(model, PipelineModel) else model
    rows: list[list] = []

    def visit(node) -> int:
        at = len(rows)
        rows.append([at, float(node.prediction()), float(node.impurity()), None, -1, -1, None, None, None])
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            rows[at][3] = float(node.gain())
            rows[at][6], rows[at][7] = int(split.featureIndex()), features[split.featureIndex()]
            rows[at][8] = float(split.threshold())
            rows[at][4] = visit(node.leftChild())
            rows[at][5] = visit(node.rightChild())
        return at

    visit(tree._call_java("rootNode"))
    schema = "id INT, prediction DOUBLE, impurity DOUBLE, gain DOUBLE, leftChild INT, rightChild INT, feature_index INT, feature STRING, threshold DOUBLE"
    return _spark_of(tree).createDataFrame([tuple(r) for r in rows], schema).orderBy("id")


def _spark_of(_model):
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def confusion_wide(cm: DataFrame, max_labels: int = 500) -> DataFrame:
    """Display form of :func:`confusion_matrix`: one row per truth label, one column per
    predicted label (a missing one is the column ``NULL``), labels in order, NULL last.

    Columns are bounded by ``max_labels``; more labels raise.
    """
    labels = [r[0] for r in cm.select("predicted").distinct().limit(max_labels + 1).collect()]
    if len(labels) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    labels.sort(key=lambda v: (v is None, v))
    one = [F.sum(F.when(F.col("predicted").eqNullSafe(F.lit(v)), F.col("count"))).alias("NULL" if v is None else str(v)) for v in labels]
    return cm.groupBy("truth").agg(*one).orderBy(F.col("truth").asc_nulls_last())


def cross_validate_ml(df: DataFrame, features: Sequence[str], label: str, fold: str = "fold", parallelism: int = 1, **kw) -> DataFrame:
    """The same CV through MLlib's ``CrossValidator`` with a user fold column: one row
    ``(mean, std)`` of fold accuracies (MLlib reports averages, not per-fold scores)."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    pipe = tree_pipeline(features, label, **kw)
    stages = pipe.getStages()
    indexed = stages[0].fit(df).transform(df).withColumn(fold, F.col(fold).cast("int"))
    inner = Pipeline(stages=stages[1:3])
    evaluator = MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction", metricName="accuracy")
    k = indexed.agg(F.max(fold)).first()[0] + 1  # folds are 0..k-1
    cv = CrossValidator(
        estimator=inner, estimatorParamMaps=ParamGridBuilder().build(), evaluator=evaluator,
        foldCol=fold, numFolds=k, parallelism=parallelism,
    )
    model = cv.fit(indexed)
    std = model.stdMetrics[0] if model.stdMetrics else None
    return df.sparkSession.createDataFrame([(float(model.avgMetrics[0]), None if std is None else float(std))], "mean DOUBLE, std DOUBLE")
