"""Exact deduplication against a minimal perfect hash over historical distinct digests.

History (documents already published) is reduced to its distinct digests. They are split into
parts by digest; each part gets a minimal perfect hash, whose slots hold the full digest, the
winner's locator and the group's size. New documents are reduced to distinct digests as well
and looked up in their part; a hit counts only if all 32 bytes agree, so a digest that the
history does not hold never passes. Nonmembers group separately.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.session import scratch_path

GAMMA = 1.5  # places per remaining key on each level
MAX_LEVELS = 200


def digest_column(text: Column) -> Column:
    """SHA-256 of the text without ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    bare = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", "")
    return F.unhex(F.sha2(bare, 256))


def _words(digests: pa.Array) -> np.ndarray:
    """Digests as an (n, 4) array of 64-bit words."""
    raw = b"".join(digests.to_pylist())
    return np.frombuffer(raw, "<u8").reshape(-1, 4)


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = words[:, 0] ^ (words[:, 1] * salt)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return (x % np.uint64(size)).astype(np.int64)


def build_perfect_hash(words: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, all levels' bits, and the slot of each of n distinct keys (a permutation).

    On each level the keys still left mark places; a place that exactly one key marks is its
    place, and the number of set bits before it is its slot, so n keys fill n slots.
    """
    left, sizes, bits, place_of, base = np.arange(len(words)), [], [], np.zeros(len(words), np.int64), 0
    while len(left):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("equal keys given to the perfect hash")
        size = max(2, math.ceil(GAMMA * len(left)))
        at = _places(words[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        won = alone[at]
        place_of[left[won]] = base + at[won]
        bits.append(alone)
        sizes.append(size)
        base += size
        left = left[~won]
    flat = np.concatenate(bits) if bits else np.zeros(0, bool)
    return sizes, flat, np.cumsum(flat)[place_of] - 1 if len(words) else place_of


def find_slots(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot that each key would have; -1 if every level turns it away. Callers compare bytes."""
    rank = np.cumsum(bits)
    out, left, base = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        at = base + _places(words[left], level, size)
        hit = bits[at]
        out[left[hit]] = rank[at[hit]] - 1
        left, base = left[~hit], base + size
    return out


def _distinct(rows: DataFrame) -> DataFrame:
    """One row per digest: size and the best row (longest, then smallest id; null ids last)."""
    best = F.struct((-F.col("n_cp")).alias("rank"), F.col("id").isNull().alias("no_id"), F.col("id"), F.col("uid"))
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("size"), F.min(best).alias("best"))


def build_index(distinct: DataFrame, parts: int) -> DataFrame:
    """The index: per part the perfect hash and its slots (digest, size, best row)."""
    best = distinct.schema["best"].dataType
    schema = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("levels", T.ArrayType(T.LongType())), T.StructField("bits", T.BinaryType()),
        T.StructField("digests", T.ArrayType(T.BinaryType())), T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("bests", T.ArrayType(best)),
    ])

    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        digests = group["digest"].combine_chunks()
        levels, bits, slots = build_perfect_hash(_words(digests))
        order = pa.array(np.argsort(slots))
        n = len(order)
        column = lambda c: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), group[c].take(order).combine_chunks())
        return pa.table({
            "part": group["part"][:1].combine_chunks(), "levels": pa.array([levels], pa.list_(pa.int64())), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            "digests": column("digest"), "sizes": column("size"), "bests": column("best"),
        })

    return distinct.withColumn("part", _part(parts)).groupBy("part").applyInArrow(build, schema)


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("long")


def look_up(distinct: DataFrame, index: DataFrame, parts: int) -> DataFrame:
    """Join new distinct digests to the index: members (``size``, ``best`` of history and, where
    the new digests hit, ``new_size``, ``new_best``) and nonmembers (history columns null)."""
    best = distinct.schema["best"].dataType
    schema = T.StructType([
        T.StructField("digest", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("best", best),
        T.StructField("new_size", T.LongType()), T.StructField("new_best", best),
    ])

    def probe(slots: pa.Table, new: pa.Table) -> pa.Table:
        new = new.combine_chunks()
        if slots.num_rows == 0:
            n = new.num_rows
            return pa.table({"digest": new["digest"], "size": pa.nulls(n, pa.int64()), "best": pa.nulls(n, new["best"].type), "new_size": new["size"], "new_best": new["best"]})
        row = {c: slots[c].combine_chunks() for c in slots.column_names}
        held, levels = row["digests"].flatten(), row["levels"].flatten().to_pylist()
        bits = np.unpackbits(np.frombuffer(row["bits"][0].as_py(), np.uint8))[: sum(levels)].astype(bool)
        hit_of = pa.nulls(len(held), pa.int64())
        others = new
        if new.num_rows:
            digests = new["digest"].combine_chunks()
            slot = find_slots(_words(digests), levels, bits)
            same = (slot >= 0) & np.asarray(pc.fill_null(pc.equal(held.take(pa.array(np.maximum(slot, 0))), digests), False))
            who = np.full(len(held), -1, np.int64)
            who[slot[same]] = np.flatnonzero(same)
            hit_of = pa.array(who, mask=who < 0)
            others = new.filter(pa.array(~same))
        members = {"digest": held, "size": row["sizes"].flatten(), "best": row["bests"].flatten(), "new_size": new["size"].combine_chunks().take(hit_of), "new_best": new["best"].combine_chunks().take(hit_of)}
        n = others.num_rows
        rest = {"digest": others["digest"].combine_chunks(), "size": pa.nulls(n, pa.int64()), "best": pa.nulls(n, members["best"].type), "new_size": others["size"].combine_chunks(), "new_best": others["best"].combine_chunks()}
        return pa.table({c: pa.chunked_array([members[c], rest[c].cast(members[c].type)]) for c in members})

    new = distinct.withColumn("part", _part(parts))
    return index.groupBy("part").cogroup(new.groupBy("part")).applyInArrow(probe, schema)


def winners(rows: DataFrame, part_digests: int = 200_000) -> DataFrame:
    """One row per distinct digest over history and new rows: ``digest``, ``group_size``, ``best``.

    ``rows``: a written table (digest, id, n_cp, uid, historical). ``part_digests`` sets how
    many distinct digests one part of the index holds (about 70 bytes each in a task).
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "dedup-index")
    old, new = (_distinct(rows.filter(F.col("historical") == flag)) for flag in (True, False))
    old.write.parquet(f"{path}-old")
    new.write.parquet(f"{path}-new")
    old, new = spark.read.parquet(f"{path}-old"), spark.read.parquet(f"{path}-new")
    parts = max(1, math.ceil(max(old.count(), new.count()) / part_digests))
    build_index(old, parts).write.parquet(path)
    found = look_up(new, spark.read.parquet(path), parts)
    return found.select(
        "digest",
        (F.coalesce("size", F.lit(0)) + F.coalesce("new_size", F.lit(0))).alias("group_size"),
        F.when(F.col("best").isNull(), F.col("new_best")).when(F.col("new_best").isNull(), F.col("best")).otherwise(F.least("best", "new_best")).alias("best"),
    )


def _default_history(id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(2)) == 0


def exact_dedup(docs: DataFrame, historical: Column | None = None, id_col: str = "doc_id", text_col: str = "text", part_digests: int = 200_000) -> DataFrame:
    """Every row with the row of equal text that stays.

    Texts are equal when identical without ``[\\x20\\x09-\\x0D]``; null text counts as empty. Of
    equal texts the row with most code points stays, then the smallest id (null ids last); of
    rows repeated with the same id and length one stays. ``historical`` marks the rows the
    index is built from (half of the ids by hash if not given); the result does not depend on
    it. Columns: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``. Other columns of ``docs``
    are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "dedup-rows")
    _digest_rows(docs, historical, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    won = winners(rows, part_digests)
    return rows.join(won, "digest").select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("uid") == F.col("best.uid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _digest_rows(docs: DataFrame, historical: Column | None, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).alias("id"), digest_column(text).alias("digest"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_cp"),
        F.coalesce(_default_history(id_col) if historical is None else historical, F.lit(False)).alias("historical"),
    )


def drop_exact_copies(docs: DataFrame, historical: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, only the rows that stay (see :func:`exact_dedup`).

    A row stays if its digest, length and id are those of the winner. Should several rows agree
    in all three, one of them stays; that second step runs only over such rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "dedup-rows")
    # Rows that agree in digest, length and id are one row here, with their number as uid.
    ties = _digest_rows(docs, historical, id_col, text_col).groupBy("digest", "n_cp", "id").agg(F.count(F.lit(1)).alias("uid"), F.max("historical").alias("historical"))
    ties.write.parquet(path)
    own = uuid.uuid4().hex  # names that no column of docs has
    digest, size, won_digest, won_id, won_size, tied = (f"{n}_{own}" for n in ("digest", "size", "won_digest", "won_id", "won_size", "tied"))
    won = winners(spark.read.parquet(path)).select(
        F.col("digest").alias(won_digest), F.col("best.id").alias(won_id), (-F.col("best.rank")).alias(won_size), (F.col("best.uid") > 1).alias(tied)
    )
    won.write.parquet(f"{path}-won")
    won = spark.read.parquet(f"{path}-won")
    text = F.col(text_col).cast("string")
    marked = docs.withColumns({digest: digest_column(text), size: F.coalesce(F.length(text), F.lit(0)).cast("long")})
    on = (F.col(digest) == F.col(won_digest)) & (F.col(size) == F.col(won_size)) & F.col(id_col).eqNullSafe(F.col(won_id))
    if won.filter(tied).isEmpty():
        return marked.join(won, on, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
    kept = marked.join(won, on)
    one = kept.filter(tied).dropDuplicates([won_digest])
    return kept.filter(~F.col(tied)).unionByName(one).select(*[F.col(f"`{c}`") for c in docs.columns])
