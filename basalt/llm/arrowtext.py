"""Vectorised text helpers for Arrow batches inside ``mapInArrow`` tasks.

A text column reaches a task as one flat UTF-8 buffer with offsets. The helpers work on
that buffer with numpy, in slices of bounded size, so that no task holds more than a few
copies of one slice (or of one document, if a single document is larger).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

# ASCII white space of the dedup contracts: [\x20\x09-\x0D]
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
# One random 64-bit value per byte; upper-case A-Z share the value of their lower case.
_rng = np.random.default_rng(20240917)
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUE_LOWER = BYTE_VALUE[_LOWER]

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """multiplier**i modulo 2**64 for i < n (or its modular inverse); grown on demand."""
    base = _INVERSE if inverse else _MULTIPLIER
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 2 * SLICE_BYTES)
        out = np.ones(size, np.uint64)
        filled, step = 1, base
        while filled < size:  # double the filled part each time
            take = min(filled, size - filled)
            out[filled : filled + take] = out[:take] * np.uint64(step)
            filled += take
            step = step * step % (1 << 64)
        _powers[base] = have = out
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (xor-shift-multiply) so that every bit depends on all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The text column of a batch, null as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    return col.fill_null("") if col.null_count else col


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array: row i is bytes[offsets[i]:offsets[i + 1]]."""
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(batch: pa.RecordBatch, name: str, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows of about ``max_bytes`` of text: (rows, bytes, offsets)."""
    col = text_column(batch, name)
    raw, off = flat(col)
    start, n = 0, len(col)
    while start < n:
        end = int(np.searchsorted(off, off[start] + max_bytes, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield batch.slice(start, end - start), raw[off[start] : off[end]], off[start : end + 1] - off[start]
        start = end


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of True, cut at row boundaries."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)  # a row begins here
    first[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of per-symbol 64-bit values (polynomial, then mixed)."""
    n = len(values)
    prefix = np.empty(n + 1, np.uint64)
    prefix[0] = 0
    np.cumsum(values * powers(n), out=prefix[1:])
    raw = (prefix[ends] - prefix[starts]) * powers(n + 1, inverse=True)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def per_row(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For sorted span starts: first span index of each row, plus the total (length rows+1)."""
    return np.searchsorted(starts, offsets, side="left")


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i+1]] along axis 0; 0 for empty segments."""
    shape = (len(bounds) - 1, *values.shape[1:])
    out = np.zeros(shape, values.dtype)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full], axis=0)
    return out


def ragged_take(flat_values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate flat_values[starts[i]:starts[i]+lengths[i]] for all i."""
    total = int(lengths.sum())
    if not total:
        return flat_values[:0]
    begin = np.cumsum(lengths) - lengths
    return flat_values[np.repeat(starts - begin, lengths) + np.arange(total)]
