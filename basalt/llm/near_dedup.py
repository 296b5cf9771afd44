"""Near-duplicate groups by b-bit MinHash.

1. Signatures: every text becomes its set of word shingles (64-bit hashes), and ``perms`` minima.
   Groups of ``rows`` full minima give one band key each; of each minimum only the low two
   bits stay, packed into 64-bit words. Texts of equal sets form one class from here on.
2. Bands: classes that share a band key are candidates. Every class is first compared with one
   class of each of its buckets only, the one that meets most others over all its buckets.
3. Bit counts of the packed words, corrected for the quarter of low bits that agree by chance,
   discard pairs that would need a deviation of ``sigmas`` to reach the threshold.
4. What is left is confirmed on the full shingle sets; components follow.
5. Buckets that still hold several components are finished: their classes outside the
   bucket's largest component meet all others across components, once per pair (at the
   first band they share), and are confirmed if the bit counts of longer signatures, of
   ``LONG_PERMS`` minima, allow it. So no candidate link between two components stays
   untested. This step is quadratic: a bucket of n classes, m of them outside its largest
   component, compares up to m * n signatures under one key, all its pairs if none is linked.

With 32 bands of 4 minima a pair at similarity 0.85 shares no band with probability 6e-11.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.arrowtext import BYTE_VALUE_LOWER, WHITE, mix, per_row, runs, slices, span_hashes
from basalt.llm.components import connected_components
from basalt.session import scratch_path

LONG_PERMS = 2048

_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3]


def _odd(k: int) -> np.uint64:
    """The k-th of a sequence of odd 64-bit factors."""
    return np.uint64((_ODD[k % len(_ODD)] * (2 * (k // len(_ODD)) + 1)) & 0xFFFFFFFFFFFFFFFF)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, concatenated, and their bounds.

    Words are runs outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased. Fewer words than a
    shingle: the whole sequence is the one shingle; no word: empty.
    """
    rows = len(offsets) - 1
    starts, ends = runs(~WHITE[raw], offsets)
    first = per_row(starts, offsets)
    hashes = span_hashes(BYTE_VALUE_LOWER[raw], starts, ends) if len(starts) else np.zeros(0, np.uint64)
    n = np.diff(first)
    full = len(hashes) - words + 1
    joined = np.zeros(max(full, 0), np.uint64)
    for k in range(words):
        if full > 0:
            joined += mix(hashes[k : k + full] + _odd(k)) * _odd(k + 1)
    joined = mix(joined)
    out, bounds = [], np.zeros(rows + 1, np.int64)
    for i, (a, c) in enumerate(zip(first[:-1].tolist(), n.tolist())):
        if c >= words:
            own = np.sort(joined[a : a + c - words + 1])
            if len(own) > 1:
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif c:
            own = mix((mix(hashes[a : a + c] + _odd(4)) * (np.arange(c, dtype=np.uint64) * np.uint64(2) + np.uint64(1))).sum(keepdims=True) + np.uint64(c))
        else:
            own = hashes[:0]
        out.append(own)
        bounds[i + 1] = bounds[i] + len(own)
    return (np.concatenate(out) if out else hashes[:0]), bounds


def minima(values: np.ndarray, bounds: np.ndarray, perms: int) -> np.ndarray:
    """(rows, perms) minima under ``perms`` fixed hash functions; rows must not be empty."""
    rng = np.random.default_rng(3)
    salts = rng.integers(0, 2**63, perms, dtype=np.uint64)
    factors = rng.integers(0, 2**63, perms, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(bounds) - 1, perms), np.uint64)
    for k in range(perms):
        out[:, k] = np.minimum.reduceat((values ^ salts[k]) * factors[k], bounds[:-1])
    return out


def low_bits(m: np.ndarray) -> np.ndarray:
    """The low two bits of (mixed) minima, packed 32 to a word."""
    low = (mix(m) & np.uint64(3)).reshape(len(m), -1, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return np.bitwise_or.reduce(low, axis=2)


def _lists(x: np.ndarray) -> pa.ListArray:
    """A matrix of 64-bit words as one list per row."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1).view(np.int64)))


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """id, ``n`` (set size), ``f1``, ``f2`` (fingerprint of the set), ``bands``, ``bits``."""
    perms = bands * rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, raw, offsets in slices(batch, "text"):
                sets, bounds = shingle_sets(raw, offsets, words)
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                f = np.zeros((len(n), 2), np.uint64)
                keys, packed = np.zeros((len(n), bands), np.uint64), np.zeros((len(n), perms // 32), np.uint64)
                if len(full):
                    tight = np.append(bounds[:-1][full], bounds[-1])
                    for j in range(2):
                        f[full, j] = np.add.reduceat(mix(sets + _odd(5 + j)), tight[:-1])
                    m = minima(sets, tight, perms)
                    weights = np.array([_odd(i) for i in range(rows)], np.uint64)
                    keys[full] = mix((m.reshape(-1, bands, rows) * weights).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * _odd(3))
                    packed[full] = low_bits(m)
                yield pa.record_batch({"id": some.column(0), "n": n, "f1": f[:, 0].view(np.int64), "f2": f[:, 1].view(np.int64), "bands": _lists(keys), "bits": _lists(packed)})

    array = T.ArrayType(T.LongType())
    out = T.StructType([
        T.StructField("id", docs.schema["id"].dataType), *[T.StructField(c, T.LongType()) for c in ("n", "f1", "f2")],
        T.StructField("bands", array), T.StructField("bits", array),
    ])
    return docs.mapInArrow(sign, out)


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """(id, ``shingles``): the full set of each text as a sorted array of 64-bit hashes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, raw, offsets in slices(batch, "text"):
                sets, bounds = shingle_sets(raw, offsets, words)
                yield pa.record_batch({"id": some.column(0), "shingles": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sets.view(np.int64)))})

    return docs.mapInArrow(build, T.StructType([T.StructField("id", docs.schema["id"].dataType), T.StructField("shingles", T.ArrayType(T.LongType()))]))


def long_bits(sets: DataFrame, perms: int) -> DataFrame:
    """(rep, bits): packed low bits of ``perms`` minima of full sets."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 128):  # a few MB of minima at a time
                rows = batch.slice(a, 128)
                lists = rows.column(1)
                bounds = lists.offsets.to_numpy().astype(np.int64)
                values = lists.values.to_numpy()[bounds[0] : bounds[-1]].view(np.uint64)
                yield pa.record_batch({"rep": rows.column(0), "bits": _lists(low_bits(minima(values, bounds - bounds[0], perms)))})

    kind = sets.schema["id"].dataType
    return sets.select("id", "shingles").mapInArrow(sign, T.StructType([T.StructField("rep", kind), T.StructField("bits", T.ArrayType(T.LongType()))]))


def estimate(bits_a: str, bits_b: str, perms: int) -> Column:
    """Similarity from packed low bits: (agreeing share - 1/4) / (3/4)."""
    differ = " + ".join(f"bit_count(({bits_a}[{i}] ^ {bits_b}[{i}] | shiftrightunsigned({bits_a}[{i}] ^ {bits_b}[{i}], 1)) & 6148914691236517205L)" for i in range(perms // 32))
    return F.expr(f"(({perms} - ({differ})) / {float(perms)} - 0.25) / 0.75")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 32, rows: int = 4, sigmas: float = 6.0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept``.

    Two texts are linked when 100 * |A and B| >= percent * |A or B|. Null and empty texts have no
    shingles and no links (texts of equal non-empty sets are linked). Rows that share an id act
    as one node; rows with a null id are never linked, have component null and are kept.
    Columns beside id and text are not read; an empty table gives an empty result.
    """
    if bands * rows % 32:
        raise ValueError("bands * rows must be a multiple of 32, to fill the packed words")
    spark = docs.sparkSession
    path = scratch_path(spark, "near-dedup")
    perms = bands * rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    signed = stored(signatures(texts, words, bands, rows), "signatures")
    linkable = signed.filter("n > 0 and id is not null")
    classes = stored(
        linkable.groupBy("f1", "f2", "n").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("bits").alias("bits")), "classes"
    )
    keyed = classes.select(F.explode("bands").alias("key"), "rep")
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stored(keyed.join(buckets, "key"), "members")
    light = classes.select("rep", "n", "bits")

    def possible(a: str, b: str, perms: int) -> Column:
        """Sizes allow a link, and the estimate is at most ``sigmas`` deviations below the threshold."""
        agree = 0.25 + 0.75 * percent / 100
        lowest = (agree - sigmas * math.sqrt(agree * (1 - agree) / perms) - 0.25) / 0.75
        sizes = F.expr(f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)")
        return sizes & (estimate(f"{a}.bits", f"{b}.bits", perms) >= lowest)

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
        both = left.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
        shared = F.size(F.array_intersect("sa", "sb"))
        return stored(both.filter(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b"), name)

    # The full sets of all classes that share a bucket
    wanted = members.select(F.col("rep").alias("want")).distinct()
    sets = stored(full_sets(texts.join(wanted, texts["id"] == wanted["want"], "left_semi"), words), "sets")

    # Every class against the one of each of its buckets that meets most others
    reach = members.groupBy("rep").agg(F.sum("size").alias("reach"))
    centers = members.join(reach, "rep").groupBy("key").agg(F.max(F.struct("reach", "rep"))["rep"].alias("center"))
    first = members.join(centers, "key").filter("rep <> center").select(F.greatest("rep", "center").alias("a"), F.least("rep", "center").alias("b")).distinct()
    first = first.join(light.alias("x"), F.col("a") == F.col("x.rep")).join(light.alias("y"), F.col("b") == F.col("y.rep")).filter(possible("x", "y", perms))
    links = confirmed(stored(first.select("a", "b"), "pairs-center"), "links-center")
    parts = stored(connected_components(links), "components-center")

    # Buckets with several components left
    placed = members.join(parts, members["rep"] == parts["node"], "left").select("key", "rep", F.coalesce("component", "rep").alias("comp"))
    counts = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = counts.groupBy("key").agg(F.max(F.struct("c", "comp"))["comp"].alias("main"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("key", "main")
    open_rows = stored(placed.join(mixed, "key"), "open")
    if not open_rows.isEmpty():
        opened = open_rows.select(F.col("rep").alias("want")).distinct()
        longer = stored(long_bits(sets.join(opened, sets["id"] == opened["want"], "left_semi"), LONG_PERMS), "long-bits")
        longer = longer.join(classes.select("rep", "n", "bands"), "rep")
        open_rows = open_rows.join(longer, "rep")
        out, all_ = open_rows.filter("comp <> main").alias("o"), open_rows.alias("m")
        across = F.expr("o.key = m.key and o.comp <> m.comp and (m.comp = m.main or o.rep < m.rep)")
        once = F.expr("element_at(filter(zip_with(o.bands, m.bands, (x, y) -> if(x = y, x, null)), x -> x is not null), 1) = o.key")
        pairs = out.join(all_, across & possible("o", "m", LONG_PERMS) & once)
        pairs = stored(pairs.select(F.greatest("o.rep", "m.rep").alias("a"), F.least("o.rep", "m.rep").alias("b")), "pairs-across")
        if not pairs.isEmpty():
            links = links.unionByName(confirmed(pairs, "links-across"))
            parts = stored(connected_components(links), "components")

    of_class = classes.join(parts, classes["rep"] == parts["node"], "left").select("f1", "f2", "n", F.coalesce("component", "rep").alias("component_id"))
    joined = linkable.join(of_class, ["f1", "f2", "n"]).select("id", "n", "component_id")
    alone = signed.filter("not (n > 0 and id is not null)").select("id", "n", F.col("id").alias("component_id"))
    return joined.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, one document of each near-duplicate component.

    Null texts, empty ones and rows with a null id are linked with nothing and stay. Rows that share
    the id that stays all stay, also repeated ones; an empty table stays empty.
    """
    found = near_duplicates(docs, words, percent, id_col=id_col, text_col=text_col)
    path = scratch_path(docs.sparkSession, "near-dedup-kept")
    found.filter("kept").select(F.col(id_col).alias("__kept")).distinct().write.parquet(path)
    kept = docs.sparkSession.read.parquet(path)
    return docs.join(kept, docs[id_col].eqNullSafe(kept["__kept"]), "left_semi")
