"""Bounded samples of labelled rows for fitting, chosen by hash so that a rerun repeats them."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.session import scratch_path

_FINE = 1 << 30
MAX_VALUES = 2_000


def bounded_sample(rows: DataFrame, by: str, limit: int, salt: int = 0) -> DataFrame:
    """At most about ``limit`` rows of ``rows`` (id, ``by``): each value of ``by`` gets an equal share.

    ``by`` is a class: more than MAX_VALUES of its values raise.

    A value with fewer rows keeps them all; of the others the rows with the lowest id hashes
    stay, in expectation as many as their share (one count per value decides).
    """
    counts = {r[0]: r[1] for r in rows.groupBy(by).count().limit(MAX_VALUES + 1).collect()}
    if len(counts) > MAX_VALUES:
        raise ValueError(f"more than {MAX_VALUES} values of {by}")
    share = limit / max(1, len(counts))
    keep = F.lit(False)
    for value, n in counts.items():
        cut = int(_FINE * min(1.0, share / n))
        keep = keep | (F.col(by).eqNullSafe(F.lit(value)) & (F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(salt)), F.lit(_FINE)) < cut))
    return rows.filter(keep)


def sampled_texts(docs: DataFrame, labelled: DataFrame, limit: int, max_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text, label) of a bounded sample of the labelled rows (id, label), as a written table.

    Beside ``limit`` rows it holds ``max_bytes`` of text in expectation: if the sample is larger,
    rows leave it by the hash of their id.
    """
    chosen = bounded_sample(labelled, "label", limit).withColumnRenamed("id", "__id")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), texts["id"] == chosen["__id"]).select("id", "text", "label")
    path = scratch_path(docs.sparkSession, "sample")
    rows.write.parquet(path)
    rows = docs.sparkSession.read.schema(rows.schema).parquet(path)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total > max_bytes:
        rows = rows.filter(F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("bytes")), F.lit(_FINE)) < int(_FINE * max_bytes / total))
    return rows


def train_in_task(rows: DataFrame, train: Callable[[pa.Table], Any]) -> Any:
    """``train`` applied to a bounded table, sorted by id, inside one task; only what it returns
    comes to the driver. A lost executor costs one more run of the task."""
    schema = rows.limit(0).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema)
        yield pa.record_batch({"model": pa.array([pickle.dumps(train(table))], pa.binary())})

    ordered = rows.repartition(1).sortWithinPartitions(*[c for c in rows.columns if c in ("id", "label")])
    conf, name = rows.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, "200")  # rows may be wide: a batch of thousands would fill the executor's buffers
    try:
        made = ordered.mapInArrow(run, "model binary").first()
    finally:
        conf.set(name, before)
    return pickle.loads(made[0]) if made else train(schema.empty_table())  # no partition, no task


def id_crc(col: Column) -> Column:
    """crc32 of the id written as text (null ids: of the empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))
