"""Concatenate-and-cut packing of tokenised documents into fixed windows.

Pass 1 tokenises every document where it lies and writes the ids, each with its start inside
its own partition. Pass 2 turns the partition totals into global bases by a prefix sum and
cuts the one long id stream every ``window`` ids; a document across a cut gets one boundary
record per piece. No id is shuffled, and the only padding is at the end of the last window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.arrowtext import slices
from basalt.llm.bpe import encoder
from basalt.llm.offsets import partition_bases, with_bases
from basalt.session import scratch_path


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``ids`` (unsigned little-endian, 2 bytes each where the
    vocabulary allows, else 4), ``width``, ``n_tokens`` with the end id, ``part`` (the task)
    and ``local_start`` (tokens before it in that task). Null text counts as empty."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, start = encoder(tokenizer), TaskContext.get().partitionId(), 0
        kind = np.uint16 if bpe.dtype == np.uint16 and end_id < 1 << 16 else np.uint32
        width = np.dtype(kind).itemsize
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                ids, counts = bpe.encode(raw, offsets)
                upto = np.cumsum(counts)
                ids = np.insert(ids, upto, end_id).astype(kind)  # the end id behind each document
                ends = upto + np.arange(1, len(counts) + 1)
                cuts = np.concatenate([[0], ends]).astype(np.int64) * width
                column = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(cuts), pa.py_buffer(ids.tobytes())])
                yield pa.record_batch({
                    "id": rows.column(0), "ids": column.cast(pa.binary()), "width": np.full(len(counts), width, np.int32),
                    "n_tokens": counts + 1, "part": np.full(len(counts), part, np.int64), "local_start": start + cuts[:-1] // width,
                })
                start += int(ends[-1])

    kind = docs.schema[id_col].dataType
    out = T.StructType([
        T.StructField("id", kind), T.StructField("ids", T.BinaryType()), T.StructField("width", T.IntegerType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("part", T.LongType()), T.StructField("local_start", T.LongType()),
    ])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(encode, out)


def cut(tokens: DataFrame, window: int) -> DataFrame:
    """Boundary records of ids that carry their global start (``base + local_start``)."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = batch.column(4).to_numpy().astype(np.int64)
            n = batch.column(3).to_numpy().astype(np.int64)
            count = (begin + n - 1) // window - begin // window + 1
            row = np.repeat(np.arange(len(n)), count)
            k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            sequence = begin[row] // window + k
            start = np.maximum(sequence * window, begin[row])
            end = np.minimum((sequence + 1) * window, begin[row] + n[row])
            crc, ids, width = np.empty(len(row), np.int64), None, batch.column(2)
            for i, (r, a, b) in enumerate(zip(row.tolist(), (start - begin[row]).tolist(), (end - begin[row]).tolist())):
                if a == 0:
                    raw = memoryview(batch.column(1)[r].as_buffer())
                    ids = np.frombuffer(raw, np.uint16 if width[r].as_py() == 2 else np.uint32).astype("<u4")
                crc[i] = zlib.crc32(ids[a:b])
            yield pa.record_batch({
                "id": batch.column(0).take(pa.array(row)), "start": start - begin[row], "length": end - start, "ids_crc32": crc,
                "doc_tokens": n[row], "sequence_id": sequence, "offset": start - sequence * window,
            })

    long = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    out = T.StructType([T.StructField("id", tokens.schema["id"].dataType), *[T.StructField(c, T.LongType()) for c in long]])
    return tokens.select("id", "ids", "width", "n_tokens", (F.col("base") + F.col("local_start")).alias("begin")).mapInArrow(pieces, out)


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into windows of ``window`` ids; one row per piece of a document.

    Columns: the id, ``start`` (ids of the document before the piece), ``length``,
    ``ids_crc32`` (of the piece as little-endian 32-bit ids), ``doc_tokens``, ``sequence_id``,
    ``offset`` in the sequence. Every document ends with ``end_id``, so null and empty
    texts give one piece of one id. Repeated rows and null ids are packed like any other
    row; columns beside id and text are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "packing-ids")
    tokenize(docs, tokenizer, end_id, id_col, text_col).write.option("compression", "zstd").parquet(path)
    tokens = spark.read.parquet(path)
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    totals.write.parquet(f"{path}-totals")
    totals = spark.read.parquet(f"{path}-totals")
    based = with_bases(tokens, partition_bases(totals, "part", "total"), "part", totals.count())
    return cut(based, window).withColumnRenamed("id", id_col)
