"""Prefix sums over partition totals: the global start of each partition of a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_PARTITIONS = 200_000  # 24 bytes a row: under 5 MB


def partition_bases(totals: DataFrame, part: str, total: str) -> DataFrame:
    """(part, base): the sum of ``total`` over all smaller parts.

    ``totals`` has one row per partition of a written table, so the ordered window sees as
    many rows as that table has partitions, whatever the number of documents.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(total).over(before), F.lit(0)).alias("base"))


def with_bases(rows: DataFrame, bases: DataFrame, part: str, partitions: int) -> DataFrame:
    """Attach ``base`` to the rows of each partition; broadcast only below the stated bound."""
    return rows.join(F.broadcast(bases) if partitions <= BROADCAST_PARTITIONS else bases, part)
