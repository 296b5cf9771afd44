"""Table profiling: missing/negative/duplicate checks, value counts, describe, correlation.

Every per-column check is one aggregate pass over the table (partial aggregation on the
map side, a handful of numbers per task cross the shuffle). Exact quantiles use a
distributed sort (see :mod:`basalt.operators.ordering`) instead of a per-group buffer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.operators.ordering import _written, cumulative_within

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _long_form(df: DataFrame, cols: Sequence[str], name: str = "column", value: str = "value") -> DataFrame:
    """Stack ``cols`` into (column, value DOUBLE) rows."""
    return df.select([F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), name, value)


def _stack_one_row(one_row: DataFrame, cols: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """A one-row aggregate with columns ``{col}__{metric}`` → one row per column."""
    structs = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{m}").alias(m) for m in metrics]) for c in cols
    ]
    return one_row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def schema_report(df: DataFrame) -> DataFrame:
    """Column name, position and type (``dtypes``) as a small DataFrame."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position INT, column STRING, type STRING, nullable BOOLEAN")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: NULL (and NaN) cells and whether any exist, in one pass."""
    cols = list(cols or df.columns)
    aggs = []
    dtypes = dict(df.dtypes)
    for c in cols:
        missing = F.col(c).isNull()
        if dtypes[c] in ("double", "float"):
            missing = missing | F.isnan(c)
        aggs.append(F.count_if(missing).alias(f"{c}__n_null"))
    out = _stack_one_row(df.agg(*aggs), cols, ["n_null"])
    return out.withColumn("has_null", F.col("n_null") > 0)


def negative_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: cells below zero and whether any exist, in one pass."""
    cols = list(cols or numeric_columns(df))
    out = _stack_one_row(df.agg(*[F.count_if(F.col(c) < 0).alias(f"{c}__n_negative") for c in cols]), cols, ["n_negative"])
    return out.withColumn("has_negative", F.col("n_negative") > 0)


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows vs. distinct keys; a NULL key counts as one key (as ``drop_duplicates`` keeps one).

    One aggregate: ``count(*)`` and a distinct count of the key struct (a struct is never
    NULL, so NULL keys count as a value), planned as a two-phase aggregate on the key.
    """
    key = F.struct(*[F.col(k) for k in keys])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_distinct_keys")).withColumn(
        "is_unique", F.col("n_rows") == F.col("n_distinct_keys")
    )


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Non-NULL values with their frequency, most frequent first (ties by value)."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.col(name).desc(), F.col(col))
    )


def row_col_counts(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def _interpolated(counts: DataFrame, group: Sequence[str], probs: Sequence[float], name: str) -> DataFrame:
    """From ``(group..., value, c)`` rows, the ``quantile_cont`` of each group at ``probs``.

    Values are ranked by cumulative counts (duplicates collapsed before any shuffle); for
    each target rank only the value whose count interval contains it survives.
    """
    group = list(group)
    cum = cumulative_within(counts, group, ["value"], "c", name="cum", size="n")
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    h = (F.col("n") - 1) * F.col("q")

    def covers(t):
        return (F.col("cum") <= t) & (t < F.col("cum") + F.col("c"))

    cand = (
        cum.select(*group, "value", "cum", "c", "n", F.explode(probs_arr).alias("q"))
        .withColumn("h", h)
        .where(covers(F.floor("h")) | covers(F.ceil("h")))
    )
    agg = cand.groupBy(*group, "q").agg(
        F.max(F.when(covers(F.floor("h")), F.col("value"))).alias("lo"),
        F.max(F.when(covers(F.ceil("h")), F.col("value"))).alias("hi"),
        F.first("h").alias("h"),
    )
    return agg.select(*group, "q", (F.col("lo") + (F.col("h") - F.floor("h")) * (F.col("hi") - F.col("lo"))).alias(name))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact, linearly interpolated quantiles (``quantile_cont``) per column.

    Values are stacked and counted per (column, value) first (partial aggregation: a value
    repeated in a third of the rows is one row per task), then ranked by cumulative count
    over a range partitioning. No task holds a whole column or a whole hot value.
    """
    long = _long_form(df, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    return _interpolated(counts, ["column"], probs, "value")


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % and max per numeric column (one row each).

    ``exact=True`` matches ``quantile_cont``; ``exact=False`` uses ``percentile_approx``
    (bounded memory, one pass, relative rank error 1 / ``accuracy``) for very large columns.
    """
    cols = list(cols or numeric_columns(df))
    # NaN counts as missing (as in pandas): map it to NULL before aggregating.
    long = _long_form(df, cols).withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    base = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *(
            []
            if exact
            else [F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy).alias("_pq")]
        ),
    )
    if exact:
        q = exact_quantiles(df, cols).groupBy("column").agg(
            *[F.max(F.when(F.col("q") == p, F.col("value"))).alias(n) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]
        )
        out = base.join(q, "column", "left")
    else:
        out = base.select("*", *[F.col("_pq")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))]).drop("_pq")
    return out.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def correlation_pairs(df: DataFrame, cols: Sequence[str], method: str = "pairwise") -> DataFrame:
    """Pearson correlation of every column pair (a < b in the given order).

    Like pandas ``corr``, each pair skips rows where either value is NULL or NaN. Both methods give
    the same: ``pairwise`` is one ``corr`` aggregate per pair, all in one pass, for a few dozen columns
    (under ANSI rules it raises on a column without spread); ``gram`` is for wide tables (see
    :func:`gram_correlations`).
    """
    cols = list(cols)
    pairs = list(combinations(cols, 2))
    if method == "gram":
        return gram_correlations(df, cols)
    if method != "pairwise":
        raise ValueError("method must be 'pairwise' or 'gram'")
    known = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    one = df.agg(*[F.corr(known[a], known[b]).alias(f"{i}__r") for i, (a, b) in enumerate(pairs)])
    structs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{i}__r").alias("r")) for i, (a, b) in enumerate(pairs)]
    return one.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def gram_correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlations of all pairs from masked Gram matrices, four matrix products per Arrow batch.

    With X the values about their column means (missing ones 0) and M the flags of known values,
    X'X holds the products of a pair, X'M the sums, (X*X)'M the squares and M'M the rows of a pair, each
    over the rows that both columns know. A task sends c² numbers of each once, whatever its rows.
    A pair without two rows or without spread has NULL. An infinite value makes its pairs NaN.
    """
    cols = list(cols)
    c = len(cols)
    x = F.array(*[F.col(k).cast("double") for k in cols])
    known = [F.nanvl(F.col(k).cast("double"), F.lit(None).cast("double")) for k in cols]
    means = df.agg(*[F.avg(k).alias(f"m{i}") for i, k in enumerate(known)]).first()
    center = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, c, c))
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, c)
            m = ~np.isnan(values)
            v, flags = np.where(m, values - center, 0.0), m.astype(float)
            with np.errstate(invalid="ignore"):
                total += np.stack([flags.T @ flags, v.T @ flags, (v * v).T @ flags, v.T @ v])
        i, j = np.triu_indices(c, 1)
        n, s, q, p = total
        yield pa.record_batch({"i": i.astype(np.int32), "j": j.astype(np.int32), "n": n[i, j], "si": s[i, j], "sj": s[j, i], "qi": q[i, j], "qj": q[j, i], "p": p[i, j]})

    sums = df.select(x.alias("x")).mapInArrow(add, "i int, j int, n double, si double, sj double, qi double, qj double, p double")
    sums = sums.groupBy("i", "j").agg(*[F.sum(k).alias(k) for k in ("n", "si", "sj", "qi", "qj", "p")])
    n = F.col("n")
    spread = (F.col("qi") - F.col("si") * F.col("si") / n) * (F.col("qj") - F.col("sj") * F.col("sj") / n)
    r = F.when((n > 1) & ((spread > 0) | F.isnan(spread)), (F.col("p") - F.col("si") * F.col("sj") / n) / F.sqrt(spread))
    names = F.array(*[F.lit(k) for k in cols])
    return sums.select(F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"), r.alias("r"))


def strong_correlations(pairs: DataFrame, lo: float = 0.4, hi: float = 1.0) -> DataFrame:
    """Pairs with ``lo < |r| < hi`` (the strict upper bound drops exact duplicates)."""
    return pairs.where((F.abs("r") > lo) & (F.abs("r") < hi))


def majority_accuracy(df: DataFrame, label: str, name: str = "majority_pct") -> DataFrame:
    """Accuracy (percent, 2 decimals) of always answering the most frequent label, over all
    rows; NULL is no label, so rows without one count as wrong."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("c"))
    most = F.coalesce(F.max(F.when(F.col(label).isNotNull(), F.col("c"))), F.lit(0))
    return counts.agg(F.round(most / F.sum("c") * 100.0, 2).alias(name))


def group_quantile(df: DataFrame, group: Sequence[str], value: str, q: float = 0.5, name: str = "median", group_rows: int = 100_000) -> DataFrame:
    """Exact interpolated quantile of ``value`` per group (``quantile_cont``), one row per group.

    Groups of at most ``group_rows`` values are ranked by a window. In larger ones (group, value)
    pairs are counted first, then ranked by cumulative count inside each group; such a group, or a
    value repeated in a third of it, is never gathered into one buffer or task.
    """
    group = list(group)
    vals = df.select(*group, (F.col(value).cast("double") + F.lit(0.0)).alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
    large = None
    if group:
        large = _written(vals.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group_rows))
        if large.isEmpty():
            return _ranked(vals, group, q, name)
        large = large.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)])
        same = reduce(and_, [vals[g].eqNullSafe(large[f"__g{i}"]) for i, g in enumerate(group)])
    counted = vals if large is None else vals.join(large, same, "left_semi")
    counts = counted.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("c"))
    out = _interpolated(counts, group, [q], name).drop("q")
    return out if large is None else out.unionByName(_ranked(vals.join(large, same, "left_anti"), group, q, name))


def _ranked(vals: DataFrame, group: Sequence[str], q: float, name: str) -> DataFrame:
    """The same quantile as :func:`_interpolated`, for groups that each fit a task."""
    each = Window.partitionBy(*group)
    h, nth = F.col("__h"), F.col("__nth")
    ranked = vals.select(*group, "value", (F.row_number().over(each.orderBy("value")) - 1).alias("__nth"), ((F.count(F.lit(1)).over(each) - 1) * F.lit(float(q))).alias("__h"))
    ends = ranked.where((nth == F.floor(h)) | (nth == F.ceil(h))).groupBy(*group).agg(
        F.max(F.when(nth == F.floor(h), F.col("value"))).alias("lo"), F.max(F.when(nth == F.ceil(h), F.col("value"))).alias("hi"), F.first(h).alias("__h")
    )
    return ends.select(*group, (F.col("lo") + (h - F.floor(h)) * (F.col("hi") - F.col("lo"))).alias(name))
