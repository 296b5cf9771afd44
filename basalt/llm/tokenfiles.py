"""Token files: flat unsigned ids plus 64-bit document offsets, written and memory-mapped back.

Layout of a folder, one set of files per partition of the sorted documents:

* ``part-<n>-<attempt>.bin``: the ids, unsigned little-endian, 2 bytes where the vocabulary
  allows and 4 otherwise, documents one after another;
* ``part-<n>-<attempt>.off``: rows + 1 unsigned 64-bit offsets of the documents, counted from
  the first id of the whole data set (so the file's first offset is the partition's base);
* ``part-<n>-<attempt>.key``: the document keys, as an Arrow file;
* ``manifest``: a Parquet table of the files of committed tasks. Files of lost or repeated
  attempts are in no manifest and are never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.arrowtext import slices
from basalt.llm.bpe import encoder
from basalt.llm.offsets import partition_bases, with_bases

_MANIFEST = "part long, name string, width int, rows long, total long"


def _open(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if folder.startswith("file:") and not folder.startswith("file://"):  # Spark writes file:/x for file:///x
        folder = folder.replace("file:", "file://", 1)
    return pyarrow.fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text in ascending id order into ``folder``; returns the manifest with bases.

    Null text counts as empty; every document ends with ``end_id``. Null ids come first; rows
    of equal id stand side by side. Columns beside id and text are not read. ``folder`` is any
    URI that Spark and pyarrow both write; ``partitions`` defaults to the shuffle setting.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = encoder(tokenizer), TaskContext.get().partitionId()
        kind = np.dtype("<u2") if bpe.dtype == np.uint16 and end_id < 1 << 16 else np.dtype("<u4")
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        name, rows, total, counts_of, keys = f"part-{part:06d}-{uuid.uuid4().hex[:12]}", 0, 0, [], None
        bin_file = key_sink = None
        for batch in batches:
            for some, raw, offsets in slices(batch, "text"):
                if bin_file is None:
                    bin_file = fs.open_output_stream(f"{root}/{name}.bin")
                    key_sink = fs.open_output_stream(f"{root}/{name}.key")
                    keys = pa.ipc.new_file(key_sink, pa.schema([("key", some.column(0).type)]))
                ids, counts = bpe.encode(raw, offsets)
                bin_file.write(np.insert(ids, np.cumsum(counts), end_id).astype(kind).tobytes())
                keys.write_batch(pa.record_batch([some.column(0)], ["key"]))
                counts_of.append(counts + 1)
                rows += len(counts)
                total += int(counts.sum()) + len(counts)
        if bin_file is None:
            return
        bin_file.close()
        keys.close()
        key_sink.close()
        with fs.open_output_stream(f"{root}/{name}.off") as out:  # local offsets; rebased below
            out.write(np.concatenate([[0], np.cumsum(np.concatenate(counts_of))]).astype("<u8").tobytes())
        yield pa.record_batch({"part": [part], "name": [name], "width": pa.array([kind.itemsize], pa.int32()), "rows": [rows], "total": [total]})

    ordered = (
        docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
        .repartitionByRange(partitions, "key")
        .sortWithinPartitions("key")
    )
    ordered.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/manifest-local")
    local = spark.read.parquet(f"{folder}/manifest-local")
    files = local.count()
    based = with_bases(local, partition_bases(local, "part", "total"), "part", files).repartition(max(1, min(files, partitions)))

    def rebase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                with fs.open_input_file(f"{root}/{row['name']}.off") as f:
                    offsets = np.frombuffer(f.read(), "<u8") + np.uint64(row["base"])
                offsets_name = f"{row['name']}-{uuid.uuid4().hex[:8]}.off"
                with fs.open_output_stream(f"{root}/{offsets_name}") as f:
                    f.write(offsets.astype("<u8").tobytes())
                out.append(row | {"offsets": offsets_name})
            yield pa.RecordBatch.from_pylist(out, pa.schema([*batch.schema, ("offsets", pa.string())]))

    schema = T.StructType([*based.schema.fields, T.StructField("offsets", T.StringType())])
    based.mapInArrow(rebase, schema).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _map(fs, path: str, local: bool) -> pa.Buffer:
    if local:
        return pa.memory_map(path).read_buffer()
    with fs.open_input_file(path) as f:
        return f.read_buffer()


def read_token_files(spark: SparkSession, folder: str, key_type: T.DataType, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Every document of a token folder, from its memory-mapped files.

    Columns: the id, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` (of
    the ids as little-endian 32-bit integers) and, if asked for, ``ids`` (array of long).
    """
    manifest = spark.read.parquet(f"{folder}/manifest")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(_map(fs, f"{root}/{row['name']}.bin", local), f"<u{row['width']}")
                offsets = np.frombuffer(_map(fs, f"{root}/{row['offsets']}", local), "<u8").astype(np.int64)
                keys = pa.ipc.open_file(_map(fs, f"{root}/{row['name']}.key", local))
                at = 0
                for k in range(keys.num_record_batches):
                    key = keys.get_batch(k).column(0)
                    span = offsets[at : at + len(key) + 1]
                    at += len(key)
                    inside = (span - row["base"]).tolist()
                    crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(inside[:-1], inside[1:])]
                    out = {"key": key, "start": span[:-1], "n_tokens": np.diff(span), "ids_crc32": np.asarray(crc, np.int64)}
                    if with_ids:
                        out["ids"] = pa.ListArray.from_arrays(pa.array(np.asarray(inside) - inside[0], pa.int32()), pa.array(ids[inside[0] : inside[-1]].astype(np.int64)))
                    yield pa.record_batch(out)

    fields = [T.StructField("key", key_type), *[T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")]]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    files = max(1, manifest.count())
    return manifest.repartition(files).mapInArrow(read, T.StructType(fields)).withColumnRenamed("key", id_col)
