"""Exact classification trees, grown to pure leaves, for all folds of a cross-validation at once.

Every split is the best over all features and all values (Gini; ties go to the lowest feature,
then the lowest value) with the threshold halfway to the next value; there are no bins and no
depth limit. A node is known by its path of ``L`` and ``R`` from the root, so a parent sorts
right before its subtree.

Trees grow level by level. A *run* is one tree: each fold leaves its own rows out. Once, the rows are
sorted by each feature and packed into blocks of bounded size: a block holds its rows' values, classes
and folds and, for every run, the node that each row has come to, so rows are neither copied for the
runs nor sorted again. Per level all runs and nodes share three jobs: routing, which also counts each
block's classes by node; the sizes of the nodes; the best split of each large node. For that, a block
adds up its rows in their order from what lies in the blocks before, so the root is no hotter than any
other node, and a value that a third of the rows share may span blocks. Nodes of at most ``local_rows``
rows are set aside; at the end each row walks down to its node in every run, and each such node is
finished in one task by the same rule. Only the nodes of more rows, one line each, pass the driver;
rows, values and the blocks' counts never do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.plans.joins import bounded_broadcast
from basalt.session import scratch_path

WHOLE = -1  # the run that trains on every row
_NODE = ["run", "path"]
_MOVES, _SMALL, _LEAF = range(3)  # what becomes of a node's rows: to the children, to be finished in a task, predicted
_NO_FOLD = -(2**40)  # no fold is as low
_BLOCK_ROWS, _BLOCK_CELLS, _PACK_CELLS = 2**15, 2**19, 2**20  # rows of a block, (run, row) pairs of a block and of a walk at most


@dataclass
class Trees:
    """``nodes``: run, path, n, counts (by class), prediction, impurity, gain, feature_index, feature,
    threshold (the last four NULL at leaves). ``held_out``: run, the key columns, truth, predicted."""

    nodes: DataFrame
    held_out: DataFrame
    features: list[str]
    labels: list


def _halfway(a: float, b: float) -> float:
    middle = a / 2 + b / 2
    return a if middle >= b else middle


def _best_splits(x: np.ndarray, y: np.ndarray, at: np.ndarray, orders: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, threshold, class counts at or below it) of every node's best split; feature -1: none.
    ``at`` is the node of each row, ``orders`` the training rows by (node, value) of each feature."""
    m, classes = counts.shape
    best, feature, threshold, left = np.full(m, -np.inf), np.full(m, -1), np.full(m, np.nan), np.zeros((m, classes), np.int64)
    impure = (counts > 0).sum(axis=1) > 1
    for f, rows in enumerate(orders):
        rows = rows[impure[at[rows]]]
        node, v = at[rows], x[rows, f]
        cut = np.flatnonzero((node[1:] == node[:-1]) & (v[1:] != v[:-1]))
        if not len(cut):
            continue
        ys, first, of, before = y[rows], _heads(node), node[cut], np.zeros(m, np.int64)

        def low(c: int, cut: np.ndarray, of: np.ndarray) -> np.ndarray:
            is_class = ys == c
            upto = np.cumsum(is_class, dtype=np.int32)
            before[node[first]] = upto[first] - is_class[first]
            return upto[cut] - before[of]

        lows, highs = np.zeros(len(cut), np.int64), np.zeros(len(cut), np.int64)
        for c in range(classes):
            l = low(c, cut, of)
            lows += l * l
            l -= counts[:, c][of]
            highs += l * l
        before[node[first]] = first - 1
        n = cut - before[of]
        score = lows / n + highs / (counts.sum(axis=1)[of] - n)
        heads = _heads(of)
        most = np.maximum.reduceat(score, heads)
        group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(cut))))
        hits = np.flatnonzero(score == most[group])
        hits = hits[_heads(group[hits])]  # the lowest value of equals
        better = most > best[of[heads]]
        to, i = of[heads][better], hits[better]
        lefts = np.stack([low(c, cut[i], to) for c in range(classes)], axis=1)
        a, b = v[cut[i]], v[cut[i] + 1]
        middle = a / 2 + b / 2
        best[to], feature[to], threshold[to], left[to] = most[better], f, np.where(middle >= b, a, middle), lefts
    return feature, threshold, left


def _grow_here(path: str, x: np.ndarray, y: np.ndarray, test: np.ndarray, classes: int) -> tuple[list[str], list[np.ndarray], np.ndarray]:
    """All nodes from ``path`` down as paths and [counts, feature (-1: leaf), threshold, left counts],
    and the predicted class of every row (-1 where nothing was learned). All nodes of a level at once."""
    predicted, at = np.full(len(y), -1), np.zeros(len(y), np.int64)  # at: the node of a row in this level, -1 behind a leaf
    train = np.flatnonzero(~test)
    orders = [train[np.argsort(x[train, f], kind="stable")] for f in range(x.shape[1])]
    paths, every, found, moving = [path], [], [], np.arange(len(y))
    while paths:
        train = train[at[train] >= 0]
        counts = np.bincount(at[train] * classes + y[train], minlength=len(paths) * classes).reshape(len(paths), classes)
        feature, threshold, left = _best_splits(x, y, at, orders, counts)
        every += paths
        found.append((counts, feature, threshold, left))
        ends = feature[at[moving]] < 0
        done, moving = moving[ends], moving[~ends]
        predicted[done] = np.where(counts.any(axis=1), counts.argmax(axis=1), -1)[at[done]]
        inner = np.flatnonzero(feature >= 0)
        of = at[moving]
        at[done] = -1
        at[moving] = 2 * np.searchsorted(inner, of) + ~(x[moving, feature[of]] <= threshold[of])
        orders = [rows[at[rows] >= 0] for rows in orders]
        orders = [rows[_by(at[rows])] for rows in orders]
        paths = [paths[i] + side for i in inner for side in "LR"]
    return every, [np.concatenate(c) for c in zip(*found)], predicted


def _binary(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The parts of ``data`` between ``starts`` as binary values."""
    offsets = (starts * (data.nbytes // max(1, len(data)))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _heads(sorted_: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(sorted_) else np.zeros(0, np.int64)


def _by(of: np.ndarray) -> np.ndarray:
    """Stable order of small whole numbers; those of 16 bits are sorted in one pass."""
    return np.argsort(of.astype(np.uint16) if len(of) and of.max() < 2**16 else of, kind="stable")


def _block(f: int, block: int, x: np.ndarray, y: np.ndarray, fold: np.ndarray, at: np.ndarray, runs: np.ndarray, nodes: int, classes: int) -> pa.RecordBatch:
    """One block: its rows by value of feature ``f`` (``x`` by feature, ``at`` by run: the row's node, -1 if
    it has none any more), and per node its rows, training classes and first training value."""
    every, seen, first = np.zeros(nodes * classes, np.int64), np.zeros(nodes * classes, np.int64), np.full(nodes + 1, -1)
    back = np.arange(len(y))[::-1]
    for r, of in enumerate(at):  # run by run: short arrays stay in the cache
        of = of.astype(np.int64)
        code = (of + 1) * classes + y
        all_ = np.bincount(code, minlength=(nodes + 1) * classes)[classes:]
        test = np.flatnonzero(fold == runs[r])
        every += all_
        seen += all_ - np.bincount(code[test], minlength=(nodes + 1) * classes)[classes:]
        of[test] = -1
        first[of[::-1]] = back  # the last one set is the first row; those of no node go to the last entry
    rows, seen, first = every.reshape(nodes, classes).sum(axis=1), seen.reshape(nodes, classes), first[:-1]
    here = np.flatnonzero(rows)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(here) + 1, dtype=np.int32) * classes), pa.array(seen[here].ravel(), pa.int64()))
    stats = pa.StructArray.from_arrays([pa.array(here, pa.int32()), pa.array(rows[here], pa.int64()), pa.array(x[f][first[here]], pa.float64(), mask=first[here] < 0), lists], names=["node", "rows", "first", "seen"])
    columns = [pa.array([f], pa.int32()), pa.array([block], pa.int64()), pa.array([[v.tobytes() for v in x]], pa.list_(pa.binary())), *[pa.array([c.tobytes()], pa.binary()) for c in (y, fold, at)]]
    return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array([0, len(here)], pa.int32()), stats)], names=["f", "block", "x", "y", "fold", "at", "stats"])


_BLOCKS = "f INT, block LONG, x ARRAY<BINARY>, y BINARY, fold BINARY, at BINARY, stats ARRAY<STRUCT<node: INT, rows: LONG, first: DOUBLE, seen: ARRAY<LONG>>>"


def _at(of: bytes, runs: int, rows: int) -> np.ndarray:
    return np.frombuffer(of, f"i{len(of) // (runs * rows)}").reshape(runs, rows)


def _blocks(ready: DataFrame, width: int, runs: np.ndarray, classes: int, rows: int) -> DataFrame:
    """All rows once per feature, in the feature's order, in blocks of at most ``rows``; every row at the roots."""
    kind = np.int16 if len(runs) < 2**15 else np.int32
    fold = F.coalesce(F.col("fold").cast("long"), F.lit(_NO_FOLD)).alias("fold")
    # Rows of one value may go to several partitions.
    each = ready.select("x", "y", fold, F.monotonically_increasing_id().alias("tie")).select("*", F.posexplode("x").alias("f", "v"))
    dealt = each.repartitionByRange(_tasks(ready), "f", "v", "tie").sortWithinPartitions("f", "v").select("f", "x", "y", "fold", F.spark_partition_id().alias("part"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n, block = [], 0, 0

        def cut(all_: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, n, block
            f, x, y, fold = [np.concatenate(c) for c in zip(*waiting)]
            bounds = [*_heads(f), len(f)]
            for a, b in zip(bounds, bounds[1:]):
                for start in range(a, b, rows):
                    end = min(start + rows, b)
                    if end == len(f) and not all_:
                        waiting, n = [(f[start:], x[start:], y[start:], fold[start:])], end - start
                        return
                    at = np.repeat(np.arange(len(runs), dtype=kind), end - start).reshape(len(runs), -1)
                    yield _block(int(f[start]), block, np.ascontiguousarray(x[start:end].T), y[start:end], fold[start:end], at, runs, len(runs), classes)
                    block += 1

        for batch in batches:
            if batch.num_rows:
                block = max(block, batch.column(4)[0].as_py() << 32)
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) + 0.0  # one zero
                waiting.append((batch.column(0).to_numpy(), x, batch.column(2).to_numpy(), batch.column(3).to_numpy()))
                n += batch.num_rows
                if n > rows:
                    yield from cut(False)
        if waiting:
            yield from cut(True)

    return dealt.mapInArrow(pack, _BLOCKS)


def _routed(blocks: DataFrame, feature: np.ndarray, threshold: np.ndarray, child: np.ndarray, runs: np.ndarray, nodes: int, classes: int) -> DataFrame:
    """The blocks with their rows at the children, by the splits of this level's nodes (feature -1: none,
    as for the last entry, rows without a node). Rows that are at no node of any run are left out."""
    kind, start, child = np.int16 if nodes < 2**15 else np.int32, np.maximum(feature, 0), np.where(feature >= 0, child, -1)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                f, block, xs, y, fold, of = [c[i].as_py() for c in batch.columns]
                x, y, fold = np.stack([np.frombuffer(v) for v in xs]), np.frombuffer(y, np.int32), np.frombuffer(fold, np.int64)
                at, row, flat = np.empty((len(runs), len(y)), kind), np.arange(len(y)), x.ravel()
                for to, of in zip(at, _at(of, len(runs), len(y))):
                    of = of.astype(np.int64)
                    high = ~(flat[start[of] * len(y) + row] <= threshold[of])
                    to[:] = child[of] + (high & (feature[of] >= 0))
                keep = np.flatnonzero((at >= 0).any(axis=0))
                if len(keep):
                    yield _block(f, block, x.take(keep, axis=1), y[keep], fold[keep], at.take(keep, axis=1), runs, nodes, classes)

    return blocks.select("f", "block", "x", "y", "fold", "at").mapInArrow(route, _BLOCKS)


def _best_cuts(v: np.ndarray, y: np.ndarray, fold: np.ndarray, at: np.ndarray, runs: np.ndarray, node: np.ndarray, before: np.ndarray, total: np.ndarray, after: np.ndarray) -> list[np.ndarray]:
    """[which, score, low, high, left]: the best cut within a block for those of ``node`` that have one.
    ``before`` and ``total``: class counts of the node before the block and in all; ``after``: its next value, or NaN."""
    slot = np.full(max(at.max(initial=0), node.max()) + 2, -1, np.int32)  # the last entry: no node
    slot[node] = np.arange(len(node))
    nth, all_, found = before.sum(axis=1), total.sum(axis=1), []
    for r, which in enumerate(at):  # run by run: short arrays stay in the cache
        which = slot[which]
        which[fold == runs[r]] = -1
        row = np.flatnonzero(which >= 0)
        which = which[row]
        if not len(which):
            continue
        if (which != which[0]).any():
            order = _by(which)
            which, row = which[order], row[order]
        vs, ys, starts = v[row], y[row], _heads(which)
        here = which[starts]
        up = np.append(vs[1:], np.nan)
        up[np.append(starts[1:], len(vs)) - 1] = after[here]
        cut = np.flatnonzero((up != vs) & ~np.isnan(up))
        if not len(cut):
            continue
        group = np.searchsorted(starts, cut, "right") - 1  # the cut's node among those here

        def low(c: int, cut: np.ndarray, group: np.ndarray) -> np.ndarray:
            is_class = ys == c
            upto = np.cumsum(is_class, dtype=np.int32)
            return upto[cut] + (before[here, c] - upto[starts] + is_class[starts])[group]

        n = cut + (nth[here] - starts + 1)[group]
        lows, highs = np.zeros(len(cut), np.int64), np.zeros(len(cut), np.int64)
        for c in range(total.shape[1]):
            l = low(c, cut, group)
            lows += l * l
            l -= total[here, c][group]
            highs += l * l
        score = lows / n + highs / (all_[here][group] - n)
        heads = _heads(group)
        most = np.repeat(np.maximum.reduceat(score, heads), np.diff(np.append(heads, len(cut))))
        hits = np.flatnonzero(score == most)
        hits = hits[_heads(group[hits])]  # the lowest value of equals
        i, group = cut[hits], group[hits]
        left = np.stack([low(c, i, group) for c in range(total.shape[1])], axis=1)
        found.append((here[group], score[hits], vs[i], up[i], left))
    return [np.concatenate(c) for c in zip(*found)]


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda n, c: n + c)


def gini(counts: Column) -> Column:
    """1 - sum of squared class shares."""
    n = _total(counts).cast("double")
    return F.when(n > 0, 1 - F.aggregate(counts, F.lit(0.0), lambda s, c: s + (c / n) * (c / n)))


def grow(
    df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str] = (), fold: str | None = None, whole: bool = True,
    local_rows: int = 50_000, cells: int = 64, max_classes: int = 200,
) -> Trees:
    """Grow one tree per value of ``fold`` on the rows outside it and, if ``whole``, one on all rows.

    Rows without a label, or with a NULL, NaN or infinite feature, take no part. A row whose fold
    is NULL trains in every run. Class codes follow the sorted labels; more than ``max_classes`` of
    them raise. An empty table gives no nodes. A node whose rows agree in all features is a leaf;
    its prediction is its most frequent class, the first of equals. ``cells`` is the least number of
    blocks per feature; blocks only deal out the work, no split depends on them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "exact-tree")
    features, keys = list(features), list(keys)
    x = F.array(*[F.col(f).cast("double") for f in features])
    whole_row = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    key = F.struct(*[F.col(k) for k in keys] or [F.lit(0).alias("_")])
    # The input is worked out once. Rows with a missing feature stay until the labels are known.
    given = df.select(key.alias("key"), F.col(label).alias("label"), F.when(whole_row, x).alias("x"), (F.col(fold).cast("int") if fold else F.lit(None).cast("int")).alias("fold")).where("label is not null")
    given.write.parquet(f"{path}/given")
    given = spark.read.schema(given.schema).parquet(f"{path}/given")
    labels = sorted(r[0] for r in given.select("label").distinct().limit(max_classes + 1).collect())
    if len(labels) > max_classes:
        raise ValueError(f"more than {max_classes} classes")
    classes = max(1, len(labels))
    code = (F.array_position(F.array(*[F.lit(v) for v in labels]), F.col("label")) - 1).cast("int") if labels else F.lit(None).cast("int")
    ready = given.where("x is not null").select("key", code.alias("y"), "x", "fold")
    tally = ready.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()  # folds x classes
    runs = sorted({r["fold"] for r in tally if r["fold"] is not None}) + ([WHOLE] if whole else [])
    run_of, rows = np.array(runs, np.int64), sum(r["n"] for r in tally)

    longs, key_type = T.ArrayType(T.LongType()), ready.schema["key"].dataType
    run_, path_ = T.StructField("run", T.IntegerType()), T.StructField("path", T.StringType())
    node_schema = T.StructType([run_, path_, T.StructField("counts", longs), T.StructField("feature_index", T.IntegerType()), T.StructField("threshold", T.DoubleType()), T.StructField("left", longs)])
    seen_schema = T.StructType([run_, T.StructField("key", key_type), T.StructField("y", T.IntegerType()), T.StructField("predicted", T.IntegerType())])

    # Driver: the nodes from the roots down to the first of at most local_rows rows; children follow each other.
    at = [(r, "") for r in runs] if rows else []
    counts = [[sum(t["n"] for t in tally if t["y"] == c and t["fold"] != r) for c in range(classes)] for r in runs]
    feature, threshold, child, states, top, large, blocks, start, level = [], [], [], [], [], [], None, 0, 0
    per_block = max(1, min(_BLOCK_ROWS, _BLOCK_CELLS // max(1, len(runs)), -(-rows // cells)))
    while start < len(at):
        here = range(start, len(at))
        if level:
            sizes = {r["node"] + start: r["rows"] for r in blocks.where("f = 0").select(F.inline("stats")).groupBy("node").agg(F.sum("rows").alias("rows")).collect()}
        else:
            sizes = dict.fromkeys(here, rows)
        impure = [(g - start, counts[g]) for g in here if sizes[g] > local_rows and sum(c > 0 for c in counts[g]) > 1]
        splits = {}
        if impure:
            if not level:
                blocks = _written(_blocks(ready, len(features), run_of, classes, per_block), f"{path}/blocks-0")
            among = bounded_broadcast(_lines(spark, impure))
            splits = {r["node"] + start: r for r in _splits(blocks, among, run_of, classes).collect()}
        for g in here:
            split, (run, name) = splits.get(g), at[g]
            feature.append(split["f"] if split else -1)
            threshold.append(_halfway(split["low"], split["high"]) if split else np.nan)
            child.append(len(at) if split else 0)
            states.append(_SMALL if sizes[g] <= local_rows else _MOVES if split else _LEAF)
            top.append(counts[g].index(max(counts[g])) if any(counts[g]) else -1)
            if states[g] != _SMALL:
                large.append((run, name, counts[g], *((split["f"], threshold[g], split["left"]) if split else (None,) * 3)))
            if split:
                at += [(run, name + side) for side in "LR"]
                counts += [list(split["left"]), [n - c for n, c in zip(counts[g], split["left"])]]
        first, start, level = start, here.stop, level + 1
        if start < len(at):
            of = np.array([*feature[first:], -1]), np.array([*threshold[first:], np.nan]), np.array([*child[first:], 0]) - start
            blocks = _written(_routed(blocks, *of, run_of, len(at) - start, classes), f"{path}/blocks-{level}")

    both = _finished(_walked(ready, f"{path}/rows", run_of, feature, threshold, child, states), at, classes, key_type, node_schema, seen_schema) if at else spark.createDataFrame([], T.StructType([*node_schema, *seen_schema[1:]]))
    both = _written(both, f"{path}/both")
    spark.createDataFrame(large, node_schema).write.parquet(f"{path}/large")
    nodes = both.where("path is not null").select(*node_schema.names).unionByName(spark.read.schema(node_schema).parquet(f"{path}/large"))
    held = both.where("path is null").select(*seen_schema.names)
    if _LEAF in states:
        ends = pa.table([pa.array(c, k) for c, k in zip(zip(*[(g, at[g][0], top[g]) for g, state in enumerate(states) if state == _LEAF]), (pa.int32(), pa.int32(), pa.int32()))], names=["end", "run", "predicted"])
        leaf = spark.read.parquet(f"{path}/rows").where(F.col("state") == _LEAF).join(bounded_broadcast(spark.createDataFrame(ends)), "end")
        held = held.unionByName(leaf.select("run", F.inline("held"), "predicted"))
    names, label_array = F.array(*[F.lit(f) for f in features]), F.array(*[F.lit(v) for v in labels])

    def named(c: Column) -> Column:
        return F.when(c >= 0, F.get(label_array, c)) if labels else F.lit(None).cast("string")

    counts, left = F.col("counts"), F.col("left")
    right = F.zip_with(counts, left, lambda a, b: a - b)
    n = _total(counts).cast("double")
    gain = gini(counts) - _total(left) / n * gini(left) - _total(right) / n * gini(right)
    top = (F.array_position(counts, F.array_max(counts)) - 1).cast("int")
    nodes = nodes.select(*_NODE, _total(counts).alias("n"), "counts", F.when(n > 0, named(top)).alias("prediction"), gini(counts).alias("impurity"), F.when(left.isNotNull(), gain).alias("gain"),
                         "feature_index", F.get(names, F.col("feature_index")).alias("feature"), "threshold")
    held = held.select("run", *[F.col(f"key.{k}").alias(k) for k in keys], named(F.col("y")).alias("truth"), named(F.col("predicted")).alias("predicted"))
    return Trees(nodes, held, features, labels)


def _tasks(df: DataFrame) -> int:
    """For work that the bytes of a task do not tell."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _lines(spark: SparkSession, impure: list[tuple[int, list[int]]]) -> DataFrame:
    """(node, total): a line per large node."""
    node, total = zip(*impure)
    return spark.createDataFrame(pa.table([pa.array(node, pa.int32()), pa.array(total, pa.list_(pa.int64()))], names=["node", "total"]))


def _splits(blocks: DataFrame, among: DataFrame, runs: np.ndarray, classes: int) -> DataFrame:
    """(node, f, low, high, left): the best split of every node of ``among`` that has one, between the
    values ``low`` and ``high`` of feature ``f``."""
    # A line per node and block: what lies before the block, the node's counts and its next value after the block.
    stats = blocks.select("f", "block", F.inline("stats")).where("first is not null").join(among, "node")
    cells = Window.partitionBy("node", "f").orderBy("block")
    before = cells.rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(F.get("seen", F.lit(c))).over(before), F.lit(0)) for c in range(classes)]
    lines = stats.select(F.col("f").alias("of"), F.col("block").alias("in"), "node", F.array(*sums).alias("before"), "total", F.lead("first").over(cells).alias("after"))

    def scan(rows: pa.Table, lines: pa.Table) -> pa.Table:
        found = [np.zeros(0)] * 5
        if rows.num_rows and lines.num_rows:
            node, before, total = [lines[c].combine_chunks() for c in ("node", "before", "total")]
            node, before, total = node.to_numpy(), *[c.flatten().to_numpy().reshape(-1, classes) for c in (before, total)]
            after = lines["after"].to_numpy().astype(float)
            by = np.argsort(node)
            v, y, fold, of = [rows[c][0].as_py() for c in ("v", "y", "fold", "at")]
            v, y, fold = np.frombuffer(v), np.frombuffer(y, np.int32), np.frombuffer(fold, np.int64)
            best = _best_cuts(v, y, fold, _at(of, len(runs), len(y)), runs, node[by], before[by], total[by], after[by])
            found = [node[by][best[0]], *best[1:]] if best else found
        node, score, low, high, left = found
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(node) + 1, dtype=np.int32) * classes), pa.array(left.ravel().astype(np.int64)))
        f = np.full(len(node), rows["f"][0].as_py() if rows.num_rows else 0)
        return pa.Table.from_arrays([pa.array(node.astype(np.int32)), pa.array(f, pa.int32()), pa.array(score), pa.array(low), pa.array(high), lists], names=["node", "f", "score", "low", "high", "left"])

    rows = blocks.select("f", "block", F.get("x", "f").alias("v"), "y", "fold", "at").repartition(_tasks(blocks), "f", "block")
    cuts = rows.groupBy("f", "block").cogroup(lines.groupBy("of", "in")).applyInArrow(scan, "node INT, f INT, score DOUBLE, low DOUBLE, high DOUBLE, left ARRAY<LONG>")
    best = cuts.groupBy("node").agg(F.max(F.struct("score", (-F.col("f")).alias("f"), (-F.col("low")).alias("low"), "left", "high")).alias("best"))
    return best.select("node", (-F.col("best.f")).alias("f"), (-F.col("best.low")).alias("low"), "best.high", "best.left")


def _walked(ready: DataFrame, path: str, runs: np.ndarray, feature: list[int], threshold: list[float], child: list[int], states: list[int]) -> DataFrame:
    """All rows of every run at the nodes where the levels ended, packed by node: training and held-out
    rows of small nodes, held-out rows of leaves. Only held-out rows (``held``) keep their keys."""
    feature, threshold, child, states = np.array(feature), np.array(threshold), np.array(child), np.array(states)
    fold = F.coalesce(F.col("fold").cast("long"), F.lit(_NO_FOLD)).alias("fold")
    held_type = T.ArrayType(T.StructType([ready.schema["key"], T.StructField("y", T.IntegerType())]))
    schema = T.StructType([T.StructField("end", T.IntegerType()), T.StructField("state", T.IntegerType()), *[T.StructField(c, T.BinaryType()) for c in ("x", "y", "test")], T.StructField("held", held_type)])
    most = max(1, _PACK_CELLS // len(runs))

    def walk(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        n, y = rows.num_rows, rows["y"].to_numpy()
        x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        end = np.repeat(np.arange(len(runs)), n)
        moving = np.flatnonzero(feature[end] >= 0)
        while len(moving):
            of = end[moving]
            of = child[of] + ~(x[moving % n, feature[of]] <= threshold[of])
            end[moving] = of
            moving = moving[feature[of] >= 0]
        test = (rows["fold"].to_numpy() == runs[:, None]).ravel()
        kept = np.flatnonzero(test | (states[end] == _SMALL))
        kept = kept[_by(end[kept])]
        end, test, row = end[kept], test[kept], kept % n
        heads = _heads(end)
        starts = np.r_[heads, len(end)]
        held = pa.array(row[test])
        held = pa.StructArray.from_arrays([rows["key"].combine_chunks().take(held), pa.array(y[row[test]])], names=["key", "y"])
        held = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(test)][starts], pa.int32()), held)
        return pa.RecordBatch.from_arrays([pa.array(end[heads], pa.int32()), pa.array(states[end[heads]], pa.int32()), *[_binary(c, starts) for c in (x[row], y[row], test)], held], names=schema.names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, most):
                waiting.append(batch.slice(i, most))
                n += waiting[-1].num_rows
                if n >= most:
                    yield walk(pa.Table.from_batches(waiting))
                    waiting, n = [], 0
        if n:
            yield walk(pa.Table.from_batches(waiting))

    return _written(ready.select("key", "y", "x", fold).mapInArrow(pack, schema), path)


def _finished(packs: DataFrame, at: list[tuple[int, str]], classes: int, key_type: T.DataType, node_schema: T.StructType, seen_schema: T.StructType) -> DataFrame:
    """The subtrees of the small nodes, each grown in one task, as lines of ``node_schema``, and their
    held-out rows as lines of ``seen_schema`` (path NULL)."""
    schema = T.StructType([*node_schema, *seen_schema[1:]])

    def finish(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        run, start = at[group["end"][0].as_py()]
        x, y, test = [np.frombuffer(b"".join(group[c].to_pylist()), kind) for c, kind in (("x", np.float64), ("y", np.int32), ("test", np.bool_))]
        paths, (counts, feature, threshold, left), predicted = _grow_here(start, x.reshape(len(y), -1), y, test, classes)
        n, rows = len(paths), np.flatnonzero(test)
        leaf, offsets = feature < 0, pa.array(np.arange(n + 1, dtype=np.int32) * classes)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(c.ravel(), pa.int64()), mask=pa.array(m)) for c, m in ((counts, np.zeros(n, bool)), (left, leaf))]
        head = [pa.array(paths, pa.string()), lists[0], pa.array(feature, pa.int32(), mask=leaf), pa.array(threshold, pa.float64(), mask=leaf), lists[1]]
        head = [pa.array(np.full(n + len(rows), run), pa.int32()), *[pa.concat_arrays([c, pa.nulls(len(rows), c.type)]) for c in head]]
        key = group["held"].combine_chunks().flatten().field("key")
        tail = [pa.concat_arrays([pa.nulls(n, key.type), key]), pa.array([None] * n + y[rows].tolist(), pa.int32()), pa.array([None] * n + predicted[rows].tolist(), pa.int32())]
        return pa.Table.from_arrays([*head, *tail], names=schema.names)

    return packs.where(F.col("state") == _SMALL).repartition(_tasks(packs), "end").groupBy("end").applyInArrow(finish, schema)


def fold_scores(trees: Trees) -> DataFrame:
    """(fold, accuracy) over the rows that each fold's tree did not see."""
    return trees.held_out.groupBy(F.col("run").alias("fold")).agg(F.avg((F.col("truth").eqNullSafe(F.col("predicted"))).cast("double")).alias("accuracy"))


def training_accuracy(trees: Trees, run: int = WHOLE) -> DataFrame:
    """Share of a run's training rows that their leaf predicts right (one row)."""
    leaves = trees.nodes.where((F.col("run") == run) & F.col("feature").isNull())
    return leaves.agg((F.sum(F.array_max("counts")) / F.sum("n")).alias("train_accuracy"))


def importances(trees: Trees, run: int = WHOLE) -> DataFrame:
    """(feature, importance): each feature's share of the impurity that splits take away, weighted
    by rows; they sum to 1, or are 0 for a tree without splits."""
    inner = trees.nodes.where((F.col("run") == run) & F.col("feature").isNotNull())
    each = inner.groupBy("feature").agg(F.sum(F.col("n") * F.col("gain")).alias("w"))
    names = trees.nodes.sparkSession.createDataFrame([(f,) for f in trees.features], "feature STRING")
    every = Window.partitionBy()  # one row per feature
    weight = F.coalesce("w", F.lit(0.0))
    return names.join(each, "feature", "left").select("feature", F.coalesce(weight / F.nullif(F.sum(weight).over(every), F.lit(0.0)), F.lit(0.0)).alias("importance"))


def predict(trees: Trees, df: DataFrame, run: int = WHOLE, name: str = "predicted_label") -> DataFrame:
    """Add the label that a run's tree predicts; NULL for rows with a missing feature.

    Rows go down one level per join with the nodes of that level, each level written, so
    neither the tree nor the rows are gathered anywhere.
    """
    spark = df.sparkSession
    at = scratch_path(spark, "exact-tree-predict")
    nodes = trees.nodes.where(F.col("run") == run).select(F.col("path").alias("_at"), "prediction", "feature_index", "threshold")
    x = F.array(*[F.col(f).cast("double") for f in trees.features])
    known = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    moving, done, level = df.where(known).withColumn("_path", F.lit("")), [df.where(~known | known.isNull()).withColumn(name, F.lit(None).cast("string"))], 0
    while True:
        met = moving.join(nodes, F.col("_path") == F.col("_at"))
        met.write.parquet(f"{at}/{level}")
        met = spark.read.schema(met.schema).parquet(f"{at}/{level}")
        done.append(met.where("feature_index is null").select(*df.columns, F.col("prediction").alias(name)))
        met = met.where("feature_index is not null")
        if met.isEmpty():
            break
        side = F.when(F.get(x, F.col("feature_index")) <= F.col("threshold"), "L").otherwise("R")
        moving, level = met.select(*df.columns, F.concat("_path", side).alias("_path")), level + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out
