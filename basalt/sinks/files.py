"""Sinks: replace-and-write results, tuple-style text lines, coefficient tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_result(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None) -> str:
    """Write ``df`` to ``path``, replacing what is there (``mode('overwrite')``)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_tuple_text(df: DataFrame, path: str, cols: Sequence[str]) -> str:
    """One ``(a, b, ...)`` line per row, like a text dump of key/value pairs.

    Array columns print as ``[x, y]``. Order across part files holds if ``df`` was
    range-sorted (``orderBy``) before writing.
    """
    parts = []
    for c in cols:
        t = dict(df.dtypes)[c]
        if t.startswith("array"):
            parts.append(F.concat(F.lit("["), F.array_join(F.col(c).cast("array<string>"), ", "), F.lit("]")))
        else:
            parts.append(F.col(c).cast("string"))
    line = F.concat(F.lit("("), F.concat_ws(", ", *parts), F.lit(")"))
    df.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def write_delimited(df: DataFrame, path: str, sep: str = "\t") -> str:
    """Headerless delimited text (e.g. an edge list)."""
    df.write.mode("overwrite").option("sep", sep).option("header", False).csv(path)
    return path


def save_coefficients(weights: DataFrame, path: str) -> str:
    """Persist a coefficient table ``(run_id, j, w)`` as Parquet (instead of a pickle)."""
    return write_result(weights, path, "parquet")


def load_coefficients(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
