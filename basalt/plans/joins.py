"""Join-side planning.

Sides that are derived from data are joined without a hint: the adaptive planner knows
their bytes once they are computed and broadcasts them, or not, by
``spark.sql.adaptive.autoBroadcastJoinThreshold``. Only sides whose row count is fixed by a
parameter (``limit(k)``, a k-row centroid table, one row per shuffle partition) are
broadcast by a hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(small: DataFrame) -> DataFrame:
    """Broadcast a side whose row count is bounded by a parameter, not by the data."""
    return F.broadcast(small)
