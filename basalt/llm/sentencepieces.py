"""SentencePiece unigram encoding and decoding: Viterbi over a double-array trie.

The pieces and their log scores come from a model file. A text gets a whitespace marker for
every space and one in front; the best segmentation maximises the sum of piece scores, found
by dynamic programming over bytes. All distinct words of a slice advance together: one array
operation follows one trie byte for all of them. Characters that no piece covers become byte
pieces. As no piece holds the marker behind another character, the best segmentation of a
text is that of its marker-led words one after another; a model with other pieces is
handled by whole texts.

Sums are kept in double precision; of equal sums the one whose last piece is longest wins.
(A library that sums in single precision cannot tell sums apart behind a piece of score -1e9.)
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.arrowtext import BYTE_VALUE, ragged_take, segment_sums, slices, span_hashes
from basalt.llm.idcache import IdCache

MARKER = "▁"
_MARK = np.frombuffer(MARKER.encode(), np.uint8)
UNKNOWN_PENALTY = 10.0  # an unknown character scores so much below the worst piece (fixed value)


@dataclass
class Pieces:
    """A vocabulary: surfaces, log scores, and what each id is."""

    surfaces: list[str]
    scores: np.ndarray
    normal: np.ndarray  # ids that Viterbi may use
    byte_ids: np.ndarray  # id of each byte's piece, or -1
    unknown: int

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        surfaces = [sp.id_to_piece(i) for i in range(n)]
        other = np.array([sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)])
        byte_ids = np.full(256, -1, np.int64)
        for i in range(n):
            if sp.is_byte(i):
                byte_ids[int(surfaces[i][3:5], 16)] = i
        return cls(surfaces, np.array([sp.get_score(i) for i in range(n)]), ~other, byte_ids, sp.unk_id())


class DoubleArray:
    """A byte trie in two arrays: child c of node s is base[s] + c, if check there is s."""

    def __init__(self, keys: dict[bytes, int]):
        words = sorted(keys)
        base, check, value, used = [0] * 300, [-1] * 300, [-1] * 300, bytearray(300)
        used[0], check[0] = 1, 0
        level, free, wide = [(0, 0, len(words), 0)], 257, 1  # node, first and last word below it, depth
        while level:
            after = []
            for node, a, b, depth in level:
                if a < b and len(words[a]) == depth:
                    value[node] = keys[words[a]]
                    a += 1
                if a == b:
                    continue
                cuts = [a, *(i for i in range(a + 1, b) if words[i][depth] != words[i - 1][depth])]
                codes = [words[i][depth] + 1 for i in cuts]
                if len(codes) == 1:  # one child: the next free place
                    while used[free]:
                        free += 1
                    at = free - codes[0]
                else:
                    at, tries = wide, 0
                    while any(used[at + c] for c in codes):
                        at, tries = at + 1, tries + 1
                        if at + 300 > len(used):
                            break
                    if tries > 32:
                        wide = at
                grow = max(at, free) + 600 - len(used)
                if grow > 0:
                    base += [0] * grow
                    check += [-1] * grow
                    value += [-1] * grow
                    used += bytearray(grow)
                    while any(used[at + c] for c in codes):
                        at += 1
                base[node] = at
                for code, i, j in zip(codes, cuts, [*cuts[1:], b]):
                    used[at + code], check[at + code] = 1, node
                    after.append((at + code, i, j, depth + 1))
            level = after
        self.base, self.check, self.value = (np.array(x, np.int64) for x in (base, check, value))
        self.longest = max(map(len, words), default=0)
        self.base, self.check, self.value = (np.concatenate([x, np.full(300, -1, np.int64)]) for x in (self.base, self.check, self.value))

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Child of each node by a byte, -1 where there is none."""
        child = self.base[node] + byte + 1
        return np.where(self.check[child] == node, child, -1)


class Encoder:
    """Encodes and decodes flat text slices; keeps the ids of words it has met."""

    def __init__(self, path: str):
        self.pieces = p = Pieces.load(path)
        usable = np.flatnonzero(p.normal)
        self.trie = DoubleArray({p.surfaces[i].encode(): int(i) for i in usable})
        self.scores = p.scores.astype(np.float64)
        self.unknown_score = float(self.scores[usable].min()) - UNKNOWN_PENALTY
        # Words may be encoded on their own if no piece holds the marker behind another character.
        self.by_word = not any(MARKER in p.surfaces[i].lstrip(MARKER) for i in usable)
        self.lonely = not any("\n" in p.surfaces[i] for i in usable)  # a line end is always a piece of its own
        out = [s.replace(MARKER, " ").encode() if ok else b"" for s, ok in zip(p.surfaces, p.normal)]
        for byte, i in enumerate(p.byte_ids):
            if i >= 0:
                out[i] = bytes([byte])
        if p.byte_ids.min() < 0:
            out[p.unknown] = " ⁇ ".encode()
        self.out_length = np.array([len(x) for x in out])
        self.out_start = np.cumsum(self.out_length) - self.out_length
        self.out_bytes = np.frombuffer(b"".join(out), np.uint8)
        self.cache = IdCache()

    def marked(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The text with the marker for every space and before every row that is not empty."""
        space = raw == 0x20
        width = np.where(space, 3, 1)
        filled = np.diff(offsets) > 0
        lead = np.zeros(len(raw) + 1, np.int64)
        lead[offsets[:-1][filled]] = 3
        at = np.cumsum(width + lead[:-1]) - width  # new place of each byte
        out = np.empty(int(width.sum() + lead.sum()), np.uint8)
        out[at[~space]] = raw[~space]
        first = np.concatenate([at[space], at[offsets[:-1][filled]] - 3])
        for k in range(3):
            out[first + k] = _MARK[k]
        upto = np.concatenate([[0], np.cumsum(width)])[offsets] + 3 * np.concatenate([[0], np.cumsum(filled)])
        return out, upto

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every row of a flat text slice: (all ids, ids per row)."""
        text, rows = self.marked(raw, offsets)
        if not len(text):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        begin = np.zeros(len(text) + 1, bool)
        begin[rows] = True
        begin = begin[:-1]
        if self.by_word:
            mark = np.zeros(len(text), bool)
            mark[:-2] = (text[:-2] == _MARK[0]) & (text[1:-1] == _MARK[1]) & (text[2:] == _MARK[2])
            follows = np.zeros(len(text), bool)
            follows[3:] = mark[:-3]
            begin |= mark & ~follows
            if self.lonely:
                line = text == 0x0A
                begin |= line
                begin[1:] |= line[:-1]
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(text))
        hashes = span_hashes(BYTE_VALUE[text], starts, ends) | np.uint64(1)
        slots = self.cache.find(hashes)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            new, where, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            if self.cache.full_with(len(new)):
                self.cache.clear()
                return self.encode(raw, offsets)
            slots[missing] = self.cache.count + which
            self.cache.add(new, self.viterbi(text, starts[missing[where]], ends[missing[where]]))
        ids, lengths = self.cache.take(slots)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(upto[np.searchsorted(starts, rows)])

    def viterbi(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
        """Best piece ids of each span; spans of like length advance together."""
        out: list[list[int]] = [[]] * len(starts)
        order = np.argsort(ends - starts, kind="stable")
        sizes = (ends - starts)[order]
        a = 0
        while a < len(order):
            b = a + 1  # a group holds at most about 4 million table cells
            top = max(64, 2 * int(sizes[a]))
            b = min(int(np.searchsorted(sizes, top, side="right")), a + max(1, (1 << 22) // (int(sizes[a]) * 2 + 1)))
            b = max(b, a + 1)
            group = order[a:b]
            for i, ids in zip(group.tolist(), self._best(text, starts[group], ends[group])):
                out[i] = ids
            a = b
        return out

    def _best(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
        n, longest = len(starts), int((ends - starts).max())
        size = ends - starts
        best = np.full((n, longest + 1), -np.inf)
        best[:, 0] = 0
        came, piece = np.zeros((n, longest + 1), np.int32), np.full((n, longest + 1), -1, np.int32)
        for p in range(longest):
            rows = np.flatnonzero((size > p) & (best[:, p] > -np.inf))
            if not len(rows):
                continue
            lead = text[starts[rows] + p]
            width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
            node, live, single = np.zeros(len(rows), np.int64), rows, np.zeros(len(rows), bool)
            place = np.arange(len(rows))
            for k in range(1, min(self.trie.longest, longest - p) + 1):
                node = self.trie.step(node, text[starts[live] + p + k - 1].astype(np.int64))
                on = node >= 0
                node, live, place = node[on], live[on], place[on]
                if not len(live):
                    break
                ids = self.trie.value[node]
                hit = np.flatnonzero(ids >= 0)
                if len(hit):
                    single[place[hit]] |= width[place[hit]] == k
                    self._offer(best, came, piece, live[hit], p, p + k, self.scores[ids[hit]], ids[hit])
                on = size[live] > p + k
                node, live, place = node[on], live[on], place[on]
                if not len(live):
                    break
            alone = ~single  # no piece for this one character
            for w in np.unique(width[alone]):
                some = rows[alone & (width == w)]
                self._offer(best, came, piece, some, p, p + int(w), self.unknown_score, np.full(len(some), -1))
        out = []
        for i in range(n):
            at, ids = int(size[i]), []
            while at > 0:
                before, id_ = int(came[i, at]), int(piece[i, at])
                if id_ >= 0:
                    ids.append(id_)
                elif self.pieces.byte_ids.min() >= 0:
                    ids.extend(self.pieces.byte_ids[text[starts[i] + before : starts[i] + at][::-1]].tolist())
                else:
                    ids.append(self.pieces.unknown)
                at = before
            out.append(ids[::-1])
        return out

    @staticmethod
    def _offer(best, came, piece, rows, start, end, score, ids):
        total = best[rows, start] + score
        better = total > best[rows, end]
        rows = rows[better]
        best[rows, end] = total[better]
        came[rows, end] = start
        piece[rows, end] = ids[better]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of rows of ids, and their bounds: markers as spaces without the leading
        one, byte pieces as their bytes, control pieces as nothing."""
        lengths = self.out_length[ids]
        data = ragged_take(self.out_bytes, self.out_start[ids], lengths)
        upto = np.concatenate([[0], np.cumsum(segment_sums(lengths, bounds))])
        drop = upto[:-1][np.diff(upto) > 0]
        drop = drop[data[drop] == 0x20]
        keep = np.ones(len(data), bool)
        keep[drop] = False
        return data[keep], upto - np.searchsorted(drop, upto)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a model file (kept between tasks of a worker)."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: the id, ``n_pieces``, ``ids_crc32`` (of the ids as little-endian 32-bit integers),
    ``n_byte_pieces``, ``decoded_chars``, ``round_trip`` (the ids decode to the text) and, if asked for, ``ids``.

    Whole texts; null counts as empty and has no pieces. A text that itself holds the marker
    character decodes to a space there. Repeated rows and null ids are handled like any other;
    other columns are not read; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        is_byte = np.zeros(len(enc.scores), np.int64)
        is_byte[enc.pieces.byte_ids[enc.pieces.byte_ids >= 0]] = 1
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                ids, n = enc.encode(raw, offsets)
                bounds = np.concatenate([[0], np.cumsum(n)])
                data, upto = enc.decode(ids, bounds)
                chars = segment_sums(((data & 0xC0) != 0x80).astype(np.int64), upto)
                cuts = bounds.tolist()
                same = [np.array_equal(data[a:b], raw[c:d]) for a, b, c, d in zip(upto[:-1], upto[1:], offsets[:-1], offsets[1:])]
                out = {
                    "id": rows.column(0), "n_pieces": n, "ids_crc32": np.array([zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(cuts[:-1], cuts[1:])], np.int64),
                    "n_byte_pieces": segment_sums(is_byte[ids], bounds), "decoded_chars": chars, "round_trip": pa.array(same, pa.bool_()),
                }
                if with_ids:
                    out["ids"] = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.record_batch(out)

    fields = [T.StructField("id", docs.schema[id_col].dataType), *[T.StructField(c, T.LongType()) for c in ("n_pieces", "ids_crc32", "n_byte_pieces", "decoded_chars")], T.StructField("round_trip", T.BooleanType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType(fields)).withColumnRenamed("id", id_col)
