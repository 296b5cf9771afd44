"""Byte-level BPE ids of whole texts, each distinct pre-token encoded once.

The tokenizers library gives every id. Encoding 100 TB text by text would spend most of its
time on words that it has met before, so a task cuts the text into the library's own pre-tokens
with numpy, hashes them, and asks the library only for pre-tokens not yet in its cache; the
ids of a text are the concatenation of its pre-tokens' ids. Texts with a code point
from ``FAST_LIMIT`` on or with the string of an added token (the library gives it the token's
id), and tokenizer files of another make, are encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np

from basalt.llm.arrowtext import span_hashes
from basalt.llm.idcache import IdCache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

FAST_LIMIT = 0x3000
OTHER, LETTER, NUMBER, WHITE = 0, 1, 2, 3
# Unicode White_Space below FAST_LIMIT (fixed values)
_WHITE_POINTS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F]


def _byte_alphabet() -> np.ndarray:
    """Code point of the printable character that stands for each byte in byte-level BPE files."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    table = np.arange(256, dtype=np.uint32)
    table[rest] = 256 + np.arange(len(rest))
    return table


_ALPHABET = _byte_alphabet()


def _class_table() -> np.ndarray:
    table = np.zeros(FAST_LIMIT, np.uint8)
    for c in range(FAST_LIMIT):
        kind = unicodedata.category(chr(c))[0]
        table[c] = LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    table[_WHITE_POINTS] = WHITE
    return table


CLASSES = _class_table()
_POINT_VALUE = np.random.default_rng(77).integers(1, 2**63, FAST_LIMIT, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def pretoken_starts(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start index of every pre-token of the byte-level pattern, over concatenated rows.

    ``points``: code points, all below FAST_LIMIT; ``offsets``: row starts, then the length.
    """
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = CLASSES[points]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    begin = first[:n].copy()
    begin[1:] |= kind[1:] != kind[:-1]
    # White space before something else: its last character stands apart, and a last
    # plain space belongs to what follows.
    last_white = np.zeros(n, bool)
    last_white[:-1] = (kind[:-1] == WHITE) & (kind[1:] != WHITE) & ~first[1:n]
    starts = begin | last_white
    glued = np.flatnonzero(last_white & (points == 0x20)) + 1
    starts[glued] = False
    # 's 't 're 've 'm 'll 'd where a pre-token begins with the apostrophe
    apostrophe = np.flatnonzero((points == 0x27) & starts)
    apostrophe = apostrophe[apostrophe + 1 < n]
    apostrophe = apostrophe[~first[apostrophe + 1] & (kind[apostrophe + 1] == LETTER)]
    if len(apostrophe):
        a = points[apostrophe + 1]
        two_ok = apostrophe + 2 < n
        b = np.where(two_ok, points[np.minimum(apostrophe + 2, n - 1)], 0)
        b = np.where(two_ok & ~first[np.minimum(apostrophe + 2, n)], b, 0)
        one = np.isin(a, [ord("s"), ord("t"), ord("m"), ord("d")])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        hit = one | two
        starts[apostrophe[hit] + 1] = False
        after = apostrophe[hit] + np.where(one[hit], 2, 3)
        after = after[after < n]
        starts[after] |= ~first[after] & (kind[after] == LETTER) | begin[after] & ~_is_glued(after, points, last_white)
    return np.flatnonzero(starts)


def _is_glued(at: np.ndarray, points: np.ndarray, last_white: np.ndarray) -> np.ndarray:
    before = np.maximum(at - 1, 0)
    return last_white[before] & (points[before] == 0x20) & (at > 0)


class ByteBpe:
    """Encoder for one tokenizer file; keep one per worker with :func:`encoder`."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.added = [t["content"].encode() for t in spec.get("added_tokens") or [] if t["content"]]
        pre = spec.get("pre_tokenizer") or {}
        self.splittable = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
            and spec["model"]["type"] == "BPE" and not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding")
        )
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.cache = IdCache()

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every row of a flat text slice: (all ids, ids per row)."""
        if len(raw) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        leads = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # byte place of each code point
        rows = np.searchsorted(leads, offsets)
        whole = self._with_added(raw, offsets)
        if not self.splittable or whole.any() or int(points.max()) >= FAST_LIMIT:
            return self._encode_rows(raw, points, leads, rows, whole)
        return self._encode_split(raw, points, leads, rows)

    def _with_added(self, raw, offsets):
        """Which rows hold the string of an added token."""
        found, data = np.zeros(len(offsets) - 1, bool), raw.tobytes()
        for content in self.added:
            at = data.find(content, int(offsets[0]))
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                if row >= len(found):
                    break
                inside = at + len(content) <= offsets[row + 1]
                found[row] |= inside
                at = data.find(content, int(offsets[row + 1]) if inside else at + 1)
        return found

    def _encode_rows(self, raw, points, leads, rows, whole):
        """Row by row: rows with unusual code points or added tokens whole, the others by pre-tokens."""
        out, counts = [], []
        for a, b, w in zip(rows[:-1], rows[1:], whole):
            if self.splittable and not w and (a == b or int(points[a:b].max()) < FAST_LIMIT):
                ids, _ = self._encode_split(raw[leads[a] : leads[b]], points[a:b], leads[a : b + 1] - leads[a], np.array([0, b - a]))
            else:
                text = raw[leads[a] : leads[b]].tobytes().decode("utf-8")
                ids = np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            out.append(ids)
            counts.append(len(ids))
        return np.concatenate(out), np.asarray(counts, np.int64)

    def _encode_split(self, raw, points, leads, rows):
        if len(points) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(rows) - 1, np.int64)
        starts = pretoken_starts(points, rows)
        ends = np.append(starts[1:], len(points))
        hashes = span_hashes(_POINT_VALUE[points], starts, ends) | np.uint64(1)
        slots = self.cache.find(hashes)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            new, where, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            if self.cache.full_with(len(new)):
                self.cache.clear()
                return self._encode_split(raw, points, leads, rows)
            slots[missing] = self.cache.count + which
            # The library's BPE model on one pre-token, written in the byte alphabet of its JSON.
            letters, tokenize = _ALPHABET[raw].tobytes().decode("utf-32-le"), self.tokenizer.model.tokenize
            a, b = leads[starts[missing[where]]].tolist(), leads[ends[missing[where]]].tolist()
            self.cache.add(new, [[t.id for t in tokenize(letters[i:j])] for i, j in zip(a, b)])
        ids, lengths = self.cache.take(slots)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(upto[np.searchsorted(starts, rows)])


_encoders: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """The worker's encoder for a tokenizer file (kept between tasks of a worker)."""
    if path not in _encoders:
        _encoders[path] = ByteBpe(path)
    return _encoders[path]
