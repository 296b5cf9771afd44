"""Phrase collocations by Rabin-Karp fingerprints of word n-grams.

Words of a text slice are hashed with prefix polynomials over its bytes, n-grams with prefix
polynomials over the word hashes, so that every n-gram costs a subtraction and a product. The
language is part of the fingerprint. Fingerprints, not texts, are counted by the shuffle:

1. words; 2. pairs of two frequent words; 3. phrases of up to ``longest`` words all of whose
pairs are frequent, each with a second, independent fingerprint (32 bits) of the text and a pointer
to a document that holds it.

A phrase is at most as frequent as its parts, so steps 1 and 2 (counts that a collision can
only raise) hold back nothing that is frequent; what they found reaches the tasks as bitmaps
of fixed size. Counts of step 3 are per pair of fingerprints, which tells colliding phrases
apart. Only phrases that are frequent are then read from the documents their pointers name,
where both fingerprints are computed again from the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm import sieve
from basalt.llm.arrowtext import BYTE_VALUE_LOWER, _LOWER, mix, powers, runs, slices, span_hashes
from basalt.session import scratch_path

PIECE = 1 << 18  # bytes of text that are hashed at once
HELD = 600_000  # n-grams that a task counts at once
SIEVED = np.uint64(0xFFFFFFFFFFFF0000)  # bits of a fingerprint that steps 1 and 2 count by
SALTS = 64
_U = np.uint64
_STOP = np.zeros(256, bool)  # ends a piece: [.,;:!?\x0A-\x0D]
_STOP[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_GAP = _STOP.copy()
_GAP[[0x20, 0x09]] = True
_SECOND = np.random.default_rng(20251113).integers(1, 2**63, 256, dtype=np.uint64)[_LOWER] * _U(2) + _U(1)
_FOLD = _LOWER.astype(np.uint8)


class Words:
    """The words of a flat text slice and the fingerprints of their n-grams."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, language: np.ndarray):
        self.raw, self.begin, self.end = raw, *runs(~_GAP[raw], offsets)
        self.row = np.searchsorted(offsets, self.begin, side="right") - 1
        self.language = language.astype(np.int64).view(_U)
        stops = np.concatenate([[0], np.cumsum(_STOP[raw])])[self.begin]
        # Whether a word and its follower stand in one piece.
        self.joined = (stops[1:] == stops[:-1]) & (self.row[1:] == self.row[:-1])
        self._prefix: dict[bool, np.ndarray] = {}

    def places(self, n: int) -> np.ndarray:
        """First words of the n-grams that lie within a piece."""
        if len(self.begin) < n:
            return np.zeros(0, np.int64)
        whole = np.ones(len(self.begin) - n + 1, bool)
        for j in range(n - 1):
            whole &= self.joined[j : j + len(whole)]
        return np.flatnonzero(whole)

    def prints(self, at: np.ndarray, n: int, second: bool = False) -> np.ndarray:
        """Fingerprints of the n-grams that begin with the words ``at``."""
        if second not in self._prefix:
            values = span_hashes((_SECOND if second else BYTE_VALUE_LOWER)[self.raw], self.begin, self.end)
            self._prefix[second] = np.concatenate([[_U(0)], np.cumsum(values * powers(len(values)))])
        prefix = self._prefix[second]
        code = (prefix[at + n] - prefix[at]) * powers(len(prefix), inverse=True)[at]
        return mix(code + mix(self.language[self.row[at]] + _U(n + (16 if second else 0))))

    def text(self, at: int, n: int) -> str:
        return b" ".join(_FOLD[self.raw[self.begin[i] : self.end[i]]].tobytes() for i in range(at, at + n)).decode("utf-8")


def _half(prints: np.ndarray) -> np.ndarray:
    """The upper half of fingerprints."""
    return (prints >> _U(32)).astype(np.uint32).view(np.int32)


def _all(flags: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Those of ``at`` whose next n flags are all set."""
    for j in range(n):
        at = at[flags[at + j]]
    return at


def frequent_phrases(docs: DataFrame, least: int = 30, longest: int = 4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, n, phrase, count): the phrases of up to ``longest`` words that occur ``least`` times in
    a language, and with n = 0 and an empty phrase the number of words of each language.

    Letters A-Z count as lower case; ``.,;:!?`` and line ends part pieces, blanks and tabs words; no
    phrase crosses a piece. Overlapping occurrences count. Null text is empty, null language ``und``.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "phrases")
    text, lang = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    # A pointer is 40 bits: long documents come first, as they hold many phrases, so that few are read in
    # the end; then a hash of the row. Documents that share a pointer are all read.
    long_first = F.lit(63) - F.least(F.lit(63), F.floor(3 * F.log2(F.octet_length(text) + 1)))
    key = F.shiftleft(long_first.cast("long"), 34).bitwiseOR(F.xxhash64(F.col(id_col).cast("string"), text, lang).bitwiseAND(F.lit((1 << 34) - 1)))
    rows = docs.select(key.alias("key"), F.xxhash64(lang).alias("code"), lang.alias("lang"), text.alias("text"))

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
        for batch in batches:
            for some, raw, offsets in slices(batch, "text", PIECE):
                yield some, Words(raw, offsets, some.column("code").to_numpy())

    def counted(make, n: int):
        """Count the fingerprints that ``make(words)`` gives, task by task."""

        def flush(held: list[np.ndarray]) -> pa.RecordBatch:
            prints, count = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch({"print": prints.view(np.int64), "count": count.astype(np.int64)})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for _, words in words_of(batches):
                held.append(words.prints(make(words), n) & SIEVED)
                size += len(held[-1])
                if size >= HELD:
                    yield flush(held)
                    held, size = [], 0
            if size:
                yield flush(held)

        counts = rows.select("code", "text").mapInArrow(run, "print long, count long").groupBy("print").agg(F.sum("count").alias("count")).filter(F.col("count") >= least)
        counts.write.parquet(f"{path}-{n}")
        return sieve.build(spark.read.schema("print long, count long").parquet(f"{path}-{n}"), "print")

    single = counted(lambda words: words.places(1), 1)

    def known_pairs(words: Words) -> np.ndarray:
        """Pairs of two words that may be frequent."""
        known = sieve.may_hold(single.value, words.prints(words.places(1), 1))
        at = words.places(2)
        return at[known[at] & known[at + 1]]

    pairs = counted(known_pairs, 2) if longest > 1 else None
    fields = [T.StructField(n, T.IntegerType() if n == "second" else T.LongType()) for n in ("print", "second", "count", "key")]

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {n: [] for n in range(1, longest + 1)}
        size = dict.fromkeys(held, 0)

        def flush(n: int) -> pa.RecordBatch:
            a, b, k = (np.concatenate([h[i] for h in held[n]]) for i in range(3))
            held[n], size[n] = [], 0
            order = np.argsort(a, kind="stable")
            a, b, k = a[order], b[order], k[order]
            first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            return counted_rows(a[first], b[first], np.diff(np.append(first, len(a))), np.minimum.reduceat(k, first))

        def counted_rows(prints, second, count, key) -> pa.RecordBatch:
            return pa.record_batch({"print": prints.view(np.int64), "second": second, "count": count, "key": key})

        for some, words in words_of(batches):
            keys = some.column("key").to_numpy()
            present, count = np.unique(words.row, return_counts=True)
            if not len(present):
                continue
            code = words.language[present]
            # The words of a language are counted under its code, with the pointer below 0.
            yield counted_rows(mix(code), _half(mix(~code)), count, -1 - keys[present])
            for n, at in phrases(words):
                if len(at):
                    held[n].append((words.prints(at, n), _half(words.prints(at, n, True)), keys[words.row[at]]))
                    size[n] += len(at)
                if size[n] >= HELD // 2:
                    yield flush(n)
        for n in held:
            if size[n]:
                yield flush(n)

    def phrases(words: Words) -> Iterator[tuple[int, np.ndarray]]:
        """(n, first words) of all phrases that may be frequent."""
        at = words.places(1)
        yield 1, at[sieve.may_hold(single.value, words.prints(at, 1))]
        known = np.zeros(len(words.begin) + 1, bool)
        for n in range(2, longest + 1):
            if n == 2:
                at = known_pairs(words)
                at = at[sieve.may_hold(pairs.value, words.prints(at, 2))]
                known[at] = True
            else:
                at = _all(known, words.places(n), n - 1)
            yield n, at

    found = rows.select("key", "code", "text").mapInArrow(point, T.StructType(fields)).groupBy("print", "second").agg(F.sum("count").alias("count"), F.min("key").alias("key"))
    found.filter((F.col("count") >= least) | (F.col("key") < 0)).withColumn("key", F.when(F.col("key") < 0, -1 - F.col("key")).otherwise(F.col("key"))).write.parquet(f"{path}-found")
    found = spark.read.schema(T.StructType(fields)).parquet(f"{path}-found")
    for bitmap in (single, pairs):
        if bitmap is not None:
            bitmap.unpersist()

    # The texts of what was found: each from the one document that its pointer names.
    wanted = found.groupBy("key").agg(F.collect_list("print").alias("wanted"))
    out = T.StructType([*fields[:2], T.StructField("n", T.IntegerType()), T.StructField("lang", T.StringType()), T.StructField("phrase", T.StringType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, raw, offsets in slices(batch, "text", PIECE):
                want = np.unique(some.column("wanted").flatten().to_numpy()).view(_U)
                words = Words(raw, offsets, some.column("code").to_numpy())
                got: list[tuple] = []
                for n in range(longest + 1):
                    at = words.places(n) if n else np.arange(len(words.language))
                    have = words.prints(at, n) if n else mix(words.language)
                    hit = np.isin(have, want)
                    at, have = at[hit], have[hit]
                    second, row = (words.prints(at, n, True), words.row[at]) if n else (mix(~words.language[at]), at)
                    second = _half(second)
                    _, first = np.unique(np.stack([have, second.view(np.uint32).astype(_U)]), axis=1, return_index=True)
                    for i in first:
                        got.append((int(have[i].view(np.int64)), int(second[i]), n, some.column("lang")[int(row[i])].as_py(), words.text(int(at[i]), n) if n else ""))
                yield pa.record_batch([pa.array([g[i] for g in got], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string()))], names=out.names)

    named = sieve.build(found.select(F.xxhash64("key").alias("slot")), "slot", 24)

    def held_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(sieve.may_hold(named.value, batch.column(0).to_numpy().view(_U))))

    rows = rows.select(F.xxhash64("key").alias("slot"), "key", "code", "lang", "text")
    rows = rows.mapInArrow(held_by, rows.schema)
    texts = rows.join(wanted.hint("shuffle_hash"), "key").select("code", "lang", "text", "wanted").mapInArrow(read, out)
    texts = texts.dropDuplicates(["print", "second"])
    return found.join(texts, ["print", "second"]).select("lang", F.col("n").cast("long").alias("n"), "phrase", "count")


def _part(words: Column, i: Column | int, m: Column | int) -> Column:
    return F.array_join(F.slice(words, i, m), " ")


def collocations(
    docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, inside: int = 80, scale: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """Each language's best ``top`` phrases of 2 to ``longest`` words: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    ``a`` is the phrase's count (``least`` or more), ``n`` the words of the language. Cutting a
    phrase in two gives the counts ``l`` and ``r`` of its parts and floor(scale * a / (l + r)); the
    cut that scores lowest counts, the earliest of equals. A phrase that lies within a
    longer one with ``inside`` percent of its count or more is dropped. Ranks go by score, count
    (both falling) and phrase (in byte order). Arithmetic is exact (decimals beyond 64 bits).

    Null text is empty, null language ``und``; see :func:`frequent_phrases`. Null and repeated ids and
    repeated rows count like any others; without a frequent phrase, as for an empty table, the
    result is empty. Other columns are not read.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "collocations")
    frequent_phrases(docs, least, longest, id_col, text_col, lang_col).write.parquet(path)
    known = spark.read.schema("lang string, n long, phrase string, count long").parquet(path)
    words = F.split("phrase", " ")
    # Parts that some cut or containment needs: those at either end, and all of two words or more.
    parts = [(n, i, m) for n in range(2, longest + 1) for m in range(1, n) for i in range(n - m + 1) if m > 1 or i in (0, n - 1)]
    needed = F.filter(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(i).alias("i"), F.lit(m).alias("m")) for n, i, m in parts]), lambda x: x["n"] == F.col("n"))
    cut = known.filter("n > 1").select("lang", "n", "phrase", F.col("count").alias("a"), words.alias("w"), F.explode(needed).alias("x"))
    cut = cut.select("lang", "n", "phrase", "a", F.col("x.i").alias("i"), F.col("x.m").alias("m"), _part(F.col("w"), F.col("x.i") + 1, F.col("x.m")).alias("part"))
    counts = known.filter("n > 0").select("lang", F.col("phrase").alias("part"), F.col("count").alias("f"))
    cut.join(counts, ["lang", "part"]).write.parquet(f"{path}-parts")
    cut = spark.read.schema("lang string, part string, n long, phrase string, a long, i int, m int, f long").parquet(f"{path}-parts")

    def count_of(i: Column | int, m: Column | int) -> Column:
        return F.max(F.when((F.col("i") == i) & (F.col("m") == m), F.col("f")))

    sides = [x for k in range(1, longest) for x in (count_of(0, k).alias(f"l{k}"), count_of(F.lit(k), F.col("n") - k).alias(f"r{k}"))]
    whole = cut.groupBy("lang", "phrase", "n", "a").agg(*sides)

    def wide(c: Column) -> Column:
        return c.cast("decimal(19,0)")

    scored = F.array(*[
        F.when(F.col("n") > k, F.struct(F.call_function("div", wide(F.col("a")) * F.lit(scale).cast("decimal(9,0)"), wide(F.col(f"l{k}")) + wide(F.col(f"r{k}"))).alias("score"),
                                        F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        for k in range(1, longest)
    ])
    best = whole.select("lang", "phrase", "a", F.array_min(scored).alias("cut"))
    within = cut.filter((F.col("m") > 1) & (100 * wide(F.col("a")) >= inside * wide(F.col("f")))).select("lang", F.col("part").alias("phrase")).distinct()
    kept = best.join(within, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each share of a language first, so that no task ranks a whole language.
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = known.filter("n = 0").select("lang", F.col("count").alias("n"))
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
