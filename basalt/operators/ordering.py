"""Positions in a total order, computed without a single-partition window.

``row_number() over (order by ...)`` without ``partition by`` moves every row into one
task, and ``row_number() over (partition by g ...)`` moves a whole group into one task.
Both break when one key holds a third of the data. Here the order is realised by a range
repartition (sampled bounds, so a hot key is spread over several partitions), each row
gets its index inside its partition, and a prefix sum over the per-partition counts turns
that into a global position. The sorted rows are written once to the shared scratch
folder, so counts and result come from the same rows and nothing stays cached.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.plans.joins import bounded_broadcast
from basalt.session import scratch_path

_PID = "__pid"
_LOCAL = "__local"


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def positional_index(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "pos",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order``.

    Give ``order`` a unique tie-break (a key column): positions are then reproducible,
    and rows sharing a hot value are spread over several range partitions. Rows that tie
    on every ordering column fall into one partition; for counting duplicates use
    :func:`cumulative_weights` on pre-aggregated rows instead.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _cols(order)
    pid = F.spark_partition_id()
    staged = (
        _written(df)
        .repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PID, pid)
        .withColumn(_LOCAL, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
    )
    return _globally(staged, F.count(F.lit(1)), name)


def _written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the scratch folder."""
    path = scratch_path(df.sparkSession, "ordering")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _globally(staged: DataFrame, total: Column, name: str) -> DataFrame:
    """``name`` = the row's local value plus ``total`` over all earlier partitions.

    One row per partition goes through the ordered window and is broadcast: their number is
    the shuffle partitions setting, not the size of the data.
    """
    staged = _written(staged)
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    starts = staged.groupBy(_PID).agg(total.alias("__total")).select(_PID, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__start"))
    out = staged.join(bounded_broadcast(starts), _PID).withColumn(name, (F.col("__start") + F.col(_LOCAL)).cast("long"))
    return out.drop(_PID, _LOCAL, "__start")


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Null-safe equality of two arrays (NaN equals NaN, as in a grouping)."""
    equal = pc.fill_null(pc.equal(a, b), False)
    both = pc.and_(pc.is_null(a, nan_is_null=True), pc.is_null(b, nan_is_null=True))
    if pa.types.is_floating(a.type):  # NULL and NaN are different groups
        both = pc.and_(both, pc.equal(pc.is_null(a), pc.is_null(b)))
    return pc.or_(equal, both).to_numpy(zero_copy_only=False)


def _running(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], weight: str | None, name: str) -> DataFrame:
    """Add ``name``: the sum of ``weight`` (or the number of rows) before this row in its group.

    Rows stand in (group, order) order over the partitions, so a group that spans several only
    needs what the partitions before hold of it: two group values and one sum per partition go to
    the driver, and one number per partition comes back. No aggregate and no join by group.
    """
    spark = df.sparkSession
    group = list(group)
    keys = _cols([*group, *order])
    staged = _written(df).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys).withColumn(_PID, F.spark_partition_id())
    schema = T.StructType([*staged.schema.fields, T.StructField(_LOCAL, T.LongType()), T.StructField("__end", T.LongType()), T.StructField("__head", T.BooleanType()), T.StructField("__row", T.LongType())])
    at = [staged.columns.index(g) for g in group]
    of = staged.columns.index(weight) if weight else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tail, head, row = None, 0, True, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            w = batch.column(of).to_numpy(zero_copy_only=False).astype(np.int64) if weight else np.ones(n, np.int64)
            fresh = np.zeros(n, bool)
            for i in at:
                c = batch.column(i)
                fresh[1:] |= ~_same(c[1:], c[:-1])
                fresh[0] |= last is not None and not _same(c[:1], last[i])[0]
            before = np.cumsum(w) - w
            start = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))  # -1: still the last batch's group
            local = before - np.where(start >= 0, before[start], -tail)
            heads = (start < 0) & head
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local), pa.array(local + w), pa.array(heads), pa.array(np.arange(row, row + n))], names=schema.names)
            last, tail, head, row = {i: batch.column(i)[n - 1 :] for i in at}, int(local[-1] + w[-1]), bool(heads[-1]), row + n

    staged = _written(staged.mapInArrow(run, schema))
    of_row = F.struct(*group) if group else F.struct(F.lit(0).alias("all"))
    ends = staged.groupBy(_PID).agg(F.min_by(of_row, "__row").alias("first"), F.max_by(of_row, "__row").alias("last"), F.max_by("__end", "__row").alias("tail"), F.max_by("__head", "__row").alias("one"))
    carried, before, held = [], None, 0
    for r in sorted(ends.collect(), key=lambda r: r[_PID]):  # one row per partition
        carry = held if before is not None and repr(before) == repr(r["first"]) else 0
        carried.append((r[_PID], carry))
        before, held = r["last"], r["tail"] + (carry if r["one"] else 0)
    carry = spark.createDataFrame(carried, f"{_PID} INT, __carry LONG")
    out = staged.join(bounded_broadcast(carry), _PID)
    value = F.col(_LOCAL) + F.when(F.col("__head"), F.col("__carry")).otherwise(0)
    return out.withColumn(name, value).drop(_PID, _LOCAL, "__end", "__head", "__row", "__carry")


def _with_totals(df: DataFrame, group: Sequence[str], total: Column, name: str) -> DataFrame:
    """Join each group's ``total`` null-safely. One row per group: the adaptive planner broadcasts it
    if its bytes allow; else a shuffle join, whose hot groups it splits."""
    totals = df.groupBy(*group).agg(total.alias(name))
    totals = totals.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], name)
    cond = None
    for i, g in enumerate(group):
        c = df[g].eqNullSafe(totals[f"__g{i}"])
        cond = c if cond is None else cond & c
    return df.join(totals, on=cond).drop(*[f"__g{i}" for i in range(len(group))])


def rank_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    name: str = "rank",
    with_size: str | None = None,
) -> DataFrame:
    """0-based row number of each row inside its group (like ``row_number() - 1``); ``with_size`` names a
    column for the group's number of rows. Hot groups stay split over several tasks."""
    out = _running(df, group, order, None, name)
    return _with_totals(out, group, F.count(F.lit(1)), with_size) if with_size else out


def dense_codes(df: DataFrame, col: str, name: str = "code") -> DataFrame:
    """Distinct values of ``col`` (NULL excluded) with codes 0..m-1 in ascending order."""
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    return positional_index(distinct, [col], name=name).select(col, name)


def cumulative_weights(df: DataFrame, order: Sequence[str | Column], weight: str, name: str = "cum") -> DataFrame:
    """Add ``name`` = sum of ``weight`` over all rows before this one in ``order``."""
    return _running(df, [], order, weight, name)


def cumulative_within(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], weight: str, name: str = "cum", size: str = "size"
) -> DataFrame:
    """Add ``name`` = sum of ``weight`` over the rows of the group before this one in ``order``, and the
    group's total weight as ``size``.

    For pre-aggregated ``(group, value, count)`` rows this is the rank of the value's first
    occurrence, so a value repeated in a third of the data is one row here.
    """
    return _with_totals(_running(df, group, order, weight, name), group, F.sum(weight), size)
