"""A bitmap of fixed size over 64-bit keys: a broadcast whose size does not grow with the data.

It answers "may be in the set" or "surely not". Callers use it to leave keys at home that cannot
matter and shuffle the rest, so a full bitmap costs shuffle, never rows.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 27  # 2**27 bits: 16 MB, whatever the number of keys
_SEGMENT = 15  # bits of one segment of Spark's bitmap functions


def build(keys: DataFrame, column: str, bits: int = BITS) -> Broadcast:
    """Broadcast bitmap of the (well mixed) keys: the top ``bits`` bits of each key set one bit.

    The segments, at most 2**(bits - 15) of 4 KB, are made by an aggregate with map-side combine.
    """
    place = F.shiftrightunsigned(F.col(column), 64 - bits) + 1
    segments = keys.select(F.bitmap_bucket_number(place).alias("segment"), F.bitmap_bit_position(place).alias("bit"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for segment, flags in segments.groupBy("segment").agg(F.bitmap_construct_agg("bit")).toLocalIterator():
        at = (segment - 1) << (_SEGMENT - 3)
        out[at : at + len(flags)] = np.frombuffer(flags, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(out)


def may_hold(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each uint64 key may be in the set."""
    place = keys >> np.uint64(64 - (len(bitmap).bit_length() + 2))
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
