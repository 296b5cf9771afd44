"""Arrow batches of vectors as matrices, for sums inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows x width matrix, flags of the rows that are whole) of a list column.

    A row with a NULL, NaN or infinite element, or that is NULL itself, is not whole and counts as
    zeros, so it cannot reach a sum. Rows of different width raise.
    """
    n = len(column)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    width = int(sizes[there].max(initial=0))
    if (sizes[there] != width).any():
        raise ValueError("vectors of different width")
    out = np.zeros((n, width))
    out[there] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if width else 0.0
    whole = there & np.isfinite(out).all(axis=1)
    out[~whole] = 0.0
    return out, whole
