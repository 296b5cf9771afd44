"""Removal of repeated substrings by deep-shallow sorting of suffixes.

A window is a string of ``length`` bytes that starts somewhere in a text; it is repeated if the same
string also starts earlier (in a document before it, or in the same one further left). All bytes of
repeated windows go.

Equal windows are brought together without shuffling every suffix. Each window picks its least
GRAM-byte hash (leftmost of equals); equal windows pick equal grams at equal places, and neighbouring
windows mostly pick the same one. Such a run of windows with the bytes it covers is a *context*.
Runs whose gram occurs once in the corpus cannot repeat: a bitmap of fixed size keeps them at
home. The others are compared as wholes first, by gram, place and two 64-bit hashes: a run that occurs
earlier is repeated, whatever its number of copies. Only where a gram has several different runs,
as at the edges of what texts share, the bytes of the first of each are sorted by suffix, within
a task's own texts, so that a window leaves the task once, and then within buckets of grams:

* shallow: multikey quicksort on eight bytes at a time down to SHALLOW bytes,
* deep: groups of at most BLIND suffixes that still agree go into blind tries, larger groups are
  split by the next eight bytes first.

Suffixes that agree in ``length`` bytes are one window; the earliest stays.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm import sieve
from basalt.llm.arrowtext import BYTE_VALUE, mix, powers, ragged_take, runs, text_column
from basalt.session import scratch_path

GRAM = 24
SHALLOW = 32
BLIND = 16
HOT = 10_000  # different runs from which a gram's windows are dealt out by their whole content
TWICE_BITS, HOT_BITS = 24, 22  # sizes of the bitmaps of copied texts and of hot grams
CHUNK = 4 << 20  # bytes of text that a task sorts at once
BUCKET = 2 << 20  # bytes of text for each bucket of grams
BATCH = 300_000  # windows that are sorted at once, unless one gram has more
SEGMENT = 1 << 18  # windows of a long text that are cut at once
_U = np.uint64


# --- sorting -----------------------------------------------------------------------------


def _views(text: np.ndarray, size: int) -> np.ndarray:
    """Row i: text[i : i + size] (no copy); ``text`` must be padded by ``size`` bytes."""
    return np.lib.stride_tricks.as_strided(text, (len(text) - size + 1, size), (1, 1))


def _split(groups: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One multikey step: (order, new group numbers in that order) by (group, word)."""
    order = np.lexsort((words, groups))
    g, w = groups[order], words[order]
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (w[1:] != w[:-1])
    return order, np.cumsum(fresh) - 1


def blind_tries(text: np.ndarray, members: np.ndarray, known: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes of many groups at once: (G, m) starts -> sorted starts and LCPs (G, m).

    ``known`` bytes agree within each group. A group's blind trie is kept as its sorted leaves and
    the depths at which neighbours branch. A suffix goes down by branching bytes alone, is
    compared once with the leaf it arrives at, and that LCP tells where it belongs. Column 0 of
    the LCPs is -1; LCPs stop at ``length``.
    """
    view = _views(text, length)
    g, m = members.shape
    leaves, lcp = members[:, :1], np.full((g, 1), -1, np.int64)
    every = np.arange(g)
    for i in range(1, m):
        new = members[:, i]
        at, skip = np.zeros(g, np.int64), np.full(g, length + 1)
        for j in range(1, i):
            depth = lcp[:, j]
            branch = np.minimum(depth, length - 1)
            goes = (depth < length) & (text[new + branch] >= text[leaves[:, j] + branch])
            seen = depth < skip  # not inside a subtree that was left aside
            at = np.where(seen & goes, j, at)
            skip = np.where(seen, np.where(goes, length + 1, depth), skip)
        leaf = leaves[every, at]
        a, b = view[new][:, known:], view[leaf][:, known:]
        differ = a != b
        place = differ.argmax(axis=1)
        equal = ~differ[every, place]
        common = np.where(equal, length, known + place)
        above = equal | (a[every, place] > b[every, place])
        # After all leaves that agree with the leaf beyond the LCP, or before all of them.
        low = lcp <= common[:, None]
        column = np.arange(i)
        after = np.where(low & (column > at[:, None]), column, i).min(axis=1)
        before = np.where(low & (column <= at[:, None]), column, 0).max(axis=1)
        to = np.where(above, np.where(equal, at + 1, after), before)
        wide = np.arange(i + 1)
        source = np.minimum(np.where(wide < to[:, None], wide, wide - 1).clip(0), i - 1)
        leaves, moved = np.take_along_axis(leaves, source, 1), np.take_along_axis(lcp, source, 1)
        leaves[every, to] = new
        old = np.where(to < i, lcp[every, np.minimum(to, i - 1)], -1)
        moved[every, to] = np.where(above, common, old)
        following = np.flatnonzero(to < i)
        moved[following, to[following] + 1] = np.where(above, old, common)[following]
        lcp = moved
    return leaves, lcp


def equal_windows(text: np.ndarray, starts: np.ndarray, groups: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions into ``starts`` and the class of each: suffixes that agree in ``length``
    bytes within their group have one class. Suffixes that are alone in theirs are left out.

    ``text`` holds ``length`` bytes from every start on and is padded by that many.
    """
    out_at, out_class, classes = [], [], 0
    at, group = np.arange(len(starts)), groups
    words = _views(text, 8)
    depth = 0
    while len(at) and depth < length:
        left = min(8, length - depth)
        word = np.ascontiguousarray(words[starts[at] + depth]).view(">u8").ravel().astype(_U)
        if left < 8:
            word >>= _U(8 * (8 - left))
        order, number = _split(group, word)
        size = np.bincount(number)[number]
        depth += left
        at, group = at[order][size > 1], number[size > 1]
        size = size[size > 1]
        if depth < SHALLOW or depth >= length:
            continue
        small = size <= BLIND
        for m in np.unique(size[small]):
            members = at[small & (size == m)].reshape(-1, m)
            for a in range(0, len(members), 100_000):
                some = members[a : a + 100_000]
                sorted_starts, lcp = blind_tries(text, starts[some], depth, length)
                # Starts are distinct within a group, so they name its members again.
                by_start = np.argsort(starts[some], axis=1)
                place = np.argsort(np.argsort(sorted_starts, axis=1), axis=1)
                out_at.append(np.take_along_axis(some, np.take_along_axis(by_start, place, 1), 1).ravel())
                number = np.cumsum((lcp < length).ravel()) - 1
                out_class.append(number + classes)
                classes += int(number[-1]) + 1
        at, group = at[~small], group[~small]
    if len(at):
        fresh = np.ones(len(group), bool)
        fresh[1:] = group[1:] != group[:-1]
        out_at.append(at)
        out_class.append(np.cumsum(fresh) - 1 + classes)
    if not out_at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_at), np.concatenate(out_class)


# --- contexts ----------------------------------------------------------------------------


class Contexts:
    """Runs of windows that share their picked gram: parallel arrays over one flat text.

    ``key``: hash of the gram; ``lead``: bytes before the gram in the first window; ``begin``: where that window
    starts in ``text``; ``count``: windows; ``doc`` and ``start``: document number and the window's place in it.
    The order of the rows is the order of the corpus.
    """

    NAMES = ("key", "lead", "begin", "count", "doc", "start")

    def __init__(self, text: np.ndarray, length: int, **columns: np.ndarray):
        self.text, self.length = text, length
        self.__dict__.update(columns)

    def take(self, rows: np.ndarray) -> Contexts:
        return Contexts(self.text, self.length, **{n: getattr(self, n)[rows] for n in self.NAMES})

    def repeated(self) -> np.ndarray:
        """One flag per window, run after run: whether the same window comes earlier here."""
        flags = np.zeros(int(self.count.sum()), bool)
        ends = np.cumsum(self.count)
        first = ends - self.count
        same = self.earlier_run()
        row = np.flatnonzero(same >= 0)
        flags[_ranges(first[row], self.count[row])] = True
        left = np.flatnonzero(same < 0)
        order = np.argsort(self.key[left], kind="stable")
        left, key = left[order], self.key[left][order]
        alone = np.ones(len(key), bool)
        if len(key) > 1:
            twin = key[1:] == key[:-1]
            alone[1:] &= ~twin
            alone[:-1] &= ~twin
        left, key = left[~alone], key[~alone]
        padded = np.concatenate([self.text, np.zeros(self.length + 8, np.uint8)])
        for rows in _batches(key, self.count[left]):
            some = np.sort(left[rows])  # in corpus order again
            window = _ranges(first[some], self.count[some])
            step = _ranges(np.zeros(len(some), np.int64), self.count[some])
            starts = np.repeat(self.begin[some], self.count[some]) + step
            lead = np.repeat(self.lead[some], self.count[some]) - step
            group = np.repeat(self.key[some], self.count[some]) + mix(lead.astype(_U))
            at, of = equal_windows(padded, starts, group, self.length)
            if len(at):
                earliest = np.full(int(of.max()) + 1, len(starts))
                np.minimum.at(earliest, of, at)
                flags[window[at[at != earliest[of]]]] = True
        return flags

    def content(self) -> np.ndarray:
        """A hash of each run's bytes, gram and lead."""
        return mix(_hashes(self.text, self.begin, self.begin + self.count + self.length - 1) + mix(self.key + self.lead.astype(_U)))

    def earlier_run(self) -> np.ndarray:
        """For each run an earlier run with the same gram, lead and bytes, or -1 (bytes compared)."""
        n = len(self.key)
        if not n:
            return np.zeros(0, np.int64)
        size = self.count + self.length - 1
        _, first, which = np.unique(self.content(), return_index=True, return_inverse=True)
        other = first[which]
        later = np.flatnonzero(other < np.arange(n))
        later = later[(size[other[later]] == size[later]) & (self.key[other[later]] == self.key[later]) & (self.lead[other[later]] == self.lead[later])]
        out = np.full(n, -1)
        for a in range(0, len(later), 1 << 16):
            some = later[a : a + (1 << 16)]
            differs = ragged_take(self.text, self.begin[some], size[some]) != ragged_take(self.text, self.begin[other[some]], size[some])
            wrong = np.add.reduceat(differs, np.cumsum(size[some]) - size[some]) > 0
            out[some[~wrong]] = other[some[~wrong]]
        return out

    def split(self, flags: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], Contexts]:
        """(document, start, end) of the bytes under flagged windows, and the runs of the others."""
        bounds = np.concatenate([[0], np.cumsum(self.count)])
        begin, end = runs(flags, bounds)
        row = np.searchsorted(bounds, begin, side="right") - 1
        start = self.start[row] + begin - bounds[row]
        doc, stop = self.doc[row], start + (end - begin) + self.length - 1
        # Runs of neighbouring grams meet: one span.
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (start[1:] > stop[:-1])
        first = np.flatnonzero(fresh)
        spans = (doc[first], start[first], stop[np.append(first[1:], len(doc)) - 1] if len(doc) else stop)
        begin, end = runs(~flags, bounds)
        row = np.searchsorted(bounds, begin, side="right") - 1
        ahead = begin - bounds[row]
        rest = Contexts(self.text, self.length, key=self.key[row], lead=self.lead[row] - ahead, begin=self.begin[row] + ahead, count=end - begin, doc=self.doc[row], start=self.start[row] + ahead)
        return spans, rest

    def singly(self, rows: np.ndarray) -> Contexts:
        """The marked runs as runs of one window each, keyed by the whole window; the others as they are."""
        which, plain = np.flatnonzero(rows), self.take(np.flatnonzero(~rows))
        n = self.count[which]
        step = _ranges(np.zeros(len(which), np.int64), n)
        row = np.repeat(which, n)
        begin = self.begin[row] + step
        one = Contexts(self.text, self.length, key=mix(_hashes(self.text, begin, begin + self.length)), lead=np.zeros(len(row), np.int64), begin=begin,
                       count=np.ones(len(row), np.int64), doc=self.doc[row], start=self.start[row] + step)
        return Contexts(self.text, self.length, **{c: np.concatenate([getattr(plain, c), getattr(one, c)]) for c in self.NAMES})


def _batches(keys: np.ndarray, counts: np.ndarray) -> Iterator[slice]:
    """Cut sorted keys into slices of about BATCH windows, never within a key."""
    ends, a = np.cumsum(counts), 0
    last = np.append(np.flatnonzero(keys[1:] != keys[:-1]), len(keys) - 1)  # last row of each key
    while a < len(keys):
        want = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BATCH))
        b = int(last[min(np.searchsorted(last, want), len(last) - 1)]) + 1
        yield slice(a, b)
        a = b


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (count[i] numbers), for all i."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - count - first, count)


def _hashes(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of byte ranges, comparable between texts."""
    prefix = np.zeros(len(text) + 1, _U)
    np.cumsum(BYTE_VALUE[text] * powers(len(text)), out=prefix[1:])
    return (prefix[end] - prefix[begin]) * powers(len(text) + 1, inverse=True)[begin] + (end - begin).astype(_U)


def pick(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one flat text by picked gram: key, lead, first window, windows.

    ``text`` is a single piece of a document; no window crosses its end.
    """
    gram = min(GRAM, length)
    n, grams = len(text) - length + 1, len(text) - gram + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(_U), none, none, none
    at = np.arange(grams)
    keys = mix(_hashes(text, at, at + gram))
    bits = max(1, int(grams).bit_length())
    least = (keys >> _U(bits)) << _U(bits) | at.astype(_U)  # the hash first, then the place
    reach, width = length - gram + 1, 1
    while 2 * width <= reach:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[reach - width : reach - width + n])
    owner = (least & _U((1 << bits) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    owner = owner[first]
    return keys[owner], owner - first, first, np.diff(np.append(first, n))


def pieces(text: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """A document in pieces of at most SEGMENT windows: (first window, bytes)."""
    for a in range(0, max(1, len(text) - length + 1), SEGMENT):
        yield a, text[a : a + SEGMENT + length - 1]


# --- Spark -------------------------------------------------------------------------------

# A text is known by the first id that has it and the first 8 bytes of its digest.
_ORDER = [("id", "ascending"), ("mark", "ascending")]  # null ids come last


def _chunks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.Table, Contexts]]:
    """Texts (id, mark, text, size) in chunks of about CHUNK bytes, in corpus order within a chunk."""

    def cut(held: list[pa.RecordBatch]) -> tuple[pa.Table, Contexts]:
        table = pa.Table.from_batches(held).sort_by(_ORDER).combine_chunks()
        col = text_column(table.to_batches()[0], "text")
        wide = pa.types.is_large_string(col.type)
        offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        raw = np.frombuffer(col.buffers()[2], np.uint8)[: offsets[-1]]
        parts: list[list[np.ndarray]] = [[] for _ in Contexts.NAMES]
        for row in range(table.num_rows):
            a, b = offsets[row], offsets[row + 1]
            for ahead, piece in pieces(raw[a:b], length):
                key, lead, first, count = pick(piece, length)
                for part, values in zip(parts, (key, lead, a + ahead + first, count, np.full(len(key), row), ahead + first)):
                    part.append(values)
        columns = {n: np.concatenate(p) for n, p in zip(Contexts.NAMES, parts)}
        return table, Contexts(raw, length, **columns)

    held, size = [], 0
    for batch in batches:
        ends, a = np.cumsum(batch.column("size").to_numpy()), 0
        while a < batch.num_rows:
            before = int(ends[a - 1]) if a else 0
            b = min(batch.num_rows, int(np.searchsorted(ends, before + CHUNK - size)) + 1)
            held.append(batch.slice(a, b - a))
            size += int(ends[b - 1]) - before
            a = b
            if size >= CHUNK:
                yield cut(held)
                held, size = [], 0
    if held:
        yield cut(held)


class Texts:
    """The distinct texts with the first id of each: ``id``, ``mark``, ``text``, ``size``.

    ``rows`` are all rows, of which those whose mark may occur twice (a bitmap of fixed size tells)
    are to be left out, and ``again`` the distinct texts among those, as a written table.
    """

    def __init__(self, rows: DataFrame, again: DataFrame, twice: Broadcast):
        self.rows, self.again, self.twice = rows, again, twice

    def map(self, fn: Callable, schema: T.StructType | str, least: int = 0) -> DataFrame:
        """``fn`` over the batches of all texts of ``least`` bytes or more."""
        rows, again = (df.filter(F.col("size") >= least) if least else df for df in (self.rows, self.again))
        twice = self.twice

        def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return fn(_marked(batches, twice, False))

        return rows.mapInArrow(once, schema).unionByName(again.mapInArrow(fn, schema))


def _marked(batches: Iterator[pa.RecordBatch], twice: Broadcast, wanted: bool) -> Iterator[pa.RecordBatch]:
    """The rows whose mark may occur twice, or those whose mark cannot."""
    for batch in batches:
        held = sieve.may_hold(twice.value, batch.column(batch.schema.get_field_index("mark")).to_numpy().view(_U))
        yield batch.filter(pa.array(held == wanted))


def distinct_texts(docs: DataFrame, path: str, id_col: str, text_col: str) -> tuple[Texts, DataFrame]:
    """The distinct texts, and rows beyond the first of each text: ``first`` (the id of that), ``mark``,
    ``id`` and how many ``rows``. Only texts that may occur twice are shuffled."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    mark = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long").alias("mark")
    size = F.octet_length("text").cast("long").alias("size")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    counts = rows.groupBy("digest", "id").agg(F.count(F.lit(1)).alias("rows"))
    counts.write.parquet(f"{path}-rows")
    counts = spark.read.schema(counts.schema).parquet(f"{path}-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"))).alias("first")
    several = counts.groupBy("digest").agg(F.sum("rows").alias("all"), first).filter("all > 1")
    several.write.parquet(f"{path}-several")
    several = spark.read.schema(several.schema).parquet(f"{path}-several")
    twice = sieve.build(several.select(mark), "mark", TWICE_BITS)
    rows = rows.select("id", mark, "text", size, "digest")
    again = rows.mapInArrow(lambda batches: _marked(batches, twice, True), rows.schema)
    again = again.groupBy("digest", "mark", "size").agg(first, F.min("text").alias("text")).select(F.col("first.id").alias("id"), "mark", "text", "size")
    again.write.parquet(f"{path}-twice")
    again = spark.read.schema(again.schema).parquet(f"{path}-twice")
    copies = counts.join(several, "digest").withColumn("rows", F.col("rows") - F.col("id").eqNullSafe(F.col("first.id")).cast("int")).filter("rows > 0")
    return Texts(rows.select(*again.columns), again, twice), copies.select(F.col("first.id").alias("first"), mark, "id", "rows")


def _pointer(mark: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash of a place in a text."""
    return mix(mark.view(_U) + mix(start.astype(_U)))


def repeated_spans(texts: Texts, length: int, path: str) -> DataFrame:
    """(id, mark, start, end): byte ranges of the distinct texts that repeat earlier ones; they may overlap."""
    spark, kind = texts.rows.sparkSession, texts.rows.schema["id"]
    long = {n: T.StructField(n, T.LongType()) for n in ("mark", "start", "end", "key", "hash", "lead", "count", "pointer")}
    buckets = max(1, math.ceil((texts.rows.agg(F.sum("size")).first()[0] or 0) / BUCKET))
    bucket = T.StructField("bucket", T.IntegerType())

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}-{name}")
        return spark.read.schema(df.schema).parquet(f"{path}-{name}")

    # 1. Grams that occur more than once.
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, contexts in _chunks(batches, length):
            key, count = np.unique(contexts.key, return_counts=True)
            yield pa.record_batch({"key": key.view(np.int64), "n": count.astype(np.int64)})

    found = stored(texts.map(grams, "key long, n long", length).groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1"), "grams")
    again = sieve.build(found, "key")

    # 2. Runs of such grams, by hash: a run that occurs earlier as a whole is repeated as a whole.
    head = T.StructType([bucket, kind, *(long[n] for n in ("mark", "start", "end", "key", "hash", "lead", "count"))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, contexts in _chunks(batches, length):
            ids, marks = table["id"].combine_chunks(), table["mark"].to_numpy()
            contexts = contexts.take(np.flatnonzero(sieve.may_hold(again.value, contexts.key)))
            (doc, start, end), rest = contexts.split(np.repeat(contexts.earlier_run() >= 0, contexts.count))
            none = {c: pa.nulls(len(doc), pa.int64()) for c in ("key", "hash", "lead", "count")}
            yield pa.record_batch({"bucket": (marks[doc] % buckets).astype(np.int32), "id": ids.take(pa.array(doc)), "mark": marks[doc], "start": start, "end": end, **none})
            content, mark = rest.content(), marks[rest.doc]
            yield pa.record_batch({
                "bucket": (content % _U(buckets)).astype(np.int32), "id": ids.take(pa.array(rest.doc)), "mark": mark, "start": rest.start, "end": pa.nulls(len(mark), pa.int64()),
                "key": rest.key.view(np.int64), "hash": content.view(np.int64), "lead": rest.lead, "count": rest.count,
            })

    def first_runs(group: pa.Table) -> pa.Table:
        spans = group.filter(pc.is_valid(group["end"]))
        group = group.filter(pc.is_null(group["end"])).sort_by([*_ORDER, ("start", "ascending")])
        same = [group[c].to_numpy() for c in ("count", "lead", "hash", "key")]
        order = np.lexsort(same)  # stable: of equal runs the earliest comes first
        first = np.ones(len(order), bool)
        first[1:] = np.any([c[order][1:] != c[order][:-1] for c in same], axis=0)
        group = group.take(pa.array(order)).combine_chunks()
        start, size = group["start"].to_numpy(), group["count"].to_numpy() + length - 1
        out = {"id": group["id"], "mark": group["mark"], "start": group["start"], "end": pa.array(start + size, mask=first), "key": pa.array(group["key"].to_numpy(), mask=~first),
               "pointer": pa.array(_pointer(group["mark"].to_numpy(), start).view(np.int64), mask=~first)}
        nothing = pa.nulls(len(spans), pa.int64())
        return pa.concat_tables([pa.table(out), pa.table({"id": spans["id"], "mark": spans["mark"], "start": spans["start"], "end": spans["end"], "key": nothing, "pointer": nothing})])

    whole = texts.map(hashed, head, length).groupBy("bucket").applyInArrow(first_runs, T.StructType([kind, *(long[n] for n in ("mark", "start", "end", "key", "pointer"))]))
    whole = stored(whole, "runs")
    firsts = whole.filter("end is null")
    variants = stored(firsts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "variants")
    several, hot, places = sieve.build(variants, "key"), sieve.build(variants.filter(F.col("n") > HOT), "key", HOT_BITS), sieve.build(firsts, "pointer")
    again.unpersist()

    # 3. The first of each run whose gram has other runs as well: its bytes are sorted with theirs.
    sent = T.StructType([bucket, kind, *(long[n] for n in ("mark", "start", "end", "key", "lead", "count")), T.StructField("content", T.BinaryType())])

    def within_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, contexts in _chunks(batches, length):
            ids, marks = table["id"].combine_chunks(), table["mark"].to_numpy()
            wanted = sieve.may_hold(several.value, contexts.key) & sieve.may_hold(places.value, _pointer(marks[contexts.doc], contexts.start))
            contexts = contexts.take(np.flatnonzero(wanted))
            (doc, start, end), rest = contexts.split(contexts.repeated())
            n, mark = len(doc), marks[doc]
            none = {c: pa.nulls(n, pa.int64()) for c in ("key", "lead", "count")}
            yield pa.record_batch({"bucket": (mark % buckets).astype(np.int32), "id": ids.take(pa.array(doc)), "mark": mark, "start": start, "end": end, **none, "content": pa.nulls(n, pa.binary())})
            rest = rest.singly(sieve.may_hold(hot.value, rest.key))
            for a in range(0, len(rest.key), 20_000):
                some = rest.take(np.arange(a, min(a + 20_000, len(rest.key))))
                size = some.count + length - 1
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                content = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(ragged_take(some.text, some.begin, size))])
                yield pa.record_batch({
                    "bucket": (some.key % _U(buckets)).astype(np.int32), "id": ids.take(pa.array(some.doc)), "mark": marks[some.doc], "start": some.start,
                    "end": pa.nulls(len(size), pa.int64()), "key": some.key.view(np.int64), "lead": some.lead, "count": some.count, "content": content,
                })

    def between_tasks(group: pa.Table) -> pa.Table:
        names = ["id", "mark", "start", "end"]
        spans = group.filter(pc.is_valid(group["end"])).select(names)
        group = group.filter(pc.is_null(group["end"])).sort_by([*_ORDER, ("start", "ascending")]).combine_chunks()
        if not group.num_rows:
            return spans
        content = group["content"].combine_chunks()
        offsets = np.frombuffer(content.buffers()[1], np.int32)[content.offset : content.offset + len(content) + 1].astype(np.int64)
        text = np.frombuffer(content.buffers()[2], np.uint8)[: offsets[-1]]
        # Spans of one text may stand in any order here; each row is a document of its own.
        doc = np.arange(group.num_rows)
        contexts = Contexts(text, length, key=group["key"].to_numpy().view(_U), lead=group["lead"].to_numpy(), begin=offsets[:-1], count=group["count"].to_numpy(), doc=doc, start=group["start"].to_numpy())
        (row, start, end), _ = contexts.split(contexts.repeated())
        row = pa.array(row)
        found = pa.table({"id": group["id"].combine_chunks().take(row), "mark": group["mark"].combine_chunks().take(row), "start": start, "end": end})
        return pa.concat_tables([spans, found.cast(spans.schema)])

    parts = texts.map(within_task, sent, length).groupBy("bucket").applyInArrow(between_tasks, T.StructType([kind, long["mark"], long["start"], long["end"]]))
    return whole.filter("end is not null").select("id", "mark", "start", "end").unionByName(parts)


def dedup_substrings(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes``, ``removed`` (ranges of its UTF-8 bytes) and ``kept`` (the rest).

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document
    of smaller id, or further left in the same one. Overlaps count, and strings are judged on the
    input. Null and empty texts have no bytes; texts shorter than ``length`` stay whole. Null ids come
    last. Of rows with one id and one text the first stays and the others go whole; rows with one id and
    different texts follow each other by digest. Other columns are not read; an empty table gives an
    empty result. ``kept`` is binary, as a cut may split a character.

    Equal texts are one text from the start, so a task meets neither copies nor, as every
    window leaves a task once, many rows of one window.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "substrings")
    texts, copies = distinct_texts(docs, path, id_col, text_col)
    spans = repeated_spans(texts, length, path)
    removed = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    found = spans.groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_list(F.struct("start", "end")).alias("found"))
    found.write.parquet(f"{path}-found")
    found = spark.read.schema(found.schema).parquet(f"{path}-found")
    with_spans = sieve.build(found.select("_mark"), "_mark", TWICE_BITS)
    # Only texts that may have spans meet them by a shuffle.
    on = (F.col("mark") == F.col("_mark")) & F.col("id").eqNullSafe(F.col("_id"))
    shared = texts.map(lambda batches: _marked(batches, with_spans, True), texts.again.schema).join(found.hint("shuffle_hash"), on, "left").select("id", "size", "text", "found")
    schema = T.StructType([texts.again.schema["id"], T.StructField("size", T.LongType()), T.StructField("removed", removed), T.StructField("kept", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges, kept = [], []
            for text, found in zip(text_column(batch, "text"), batch.column("found")):
                raw = text.as_buffer().to_pybytes()
                gone = union_of(found.values) if found.is_valid else []
                ranges.append([{"start": a, "end": b} for a, b in gone])
                edges = [0, *(x for ab in gone for x in ab), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch([batch.column("id"), batch.column("size"), pa.array(ranges, kind), pa.array(kept, pa.binary())], names=schema.names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _marked(batches, with_spans, False):
            yield pa.record_batch([batch.column("id"), batch.column("size"), pa.array([[]] * batch.num_rows, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), batch.column("text").cast(pa.binary())], names=schema.names)

    firsts = shared.mapInArrow(cut, schema).unionByName(texts.map(whole, schema))
    # Further rows of a text: whole windows of an earlier row, if the text has a window at all.
    short = texts.again.select(F.col("id").alias("_id"), F.col("mark").alias("_mark"), "size", F.when(F.col("size") < length, F.encode("text", "UTF-8")).alias("short"))
    copies = copies.join(short, (F.col("mark") == F.col("_mark")) & F.col("first").eqNullSafe(F.col("_id")))
    all_of_it = F.when(F.col("size") >= length, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("end")))).otherwise(F.array().cast(removed))
    copies = copies.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).select("id", "size", all_of_it.alias("removed"), F.coalesce("short", F.lit(b"")).alias("kept"))
    return firsts.unionByName(copies).select(F.col("id").alias(id_col), F.col("size").alias("n_bytes"), "removed", "kept")


def union_of(ranges: pa.StructArray) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the ranges."""
    start, end = ranges.field("start").to_numpy(), ranges.field("end").to_numpy()
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return list(zip(start[first].tolist(), end[np.append(first[1:], len(start)) - 1].tolist()))
