"""Cleaning: parse '12%' / '$123' text to numbers, drop rows by value, merge categories,
encode labels. All built-in expressions; lookups join small measured tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.functions.text import strip_and_cast
from basalt.operators.ordering import dense_codes


def parse_number(df: DataFrame, cols: Sequence[str], strip: str = "%", strict: bool = False, to: str = "double") -> DataFrame:
    """Replace each text column by its number after removing the ``strip`` characters.

    ``strict`` raises on text that is not a number; otherwise such cells become NULL.
    Pass ``strip="$,"`` to also drop thousands separators.
    """
    out = df
    for c in cols:
        out = out.withColumn(c, strip_and_cast(c, strip, to=to, strict=strict))
    return out


def parse_failures(raw: DataFrame, cols: Sequence[str], strip: str = "%") -> DataFrame:
    """Per column: non-NULL text cells that do not parse as a number (one aggregate)."""
    aggs = [
        F.count_if(F.col(c).isNotNull() & strip_and_cast(c, strip).isNull()).alias(c) for c in cols
    ]
    return raw.agg(*aggs).unpivot([], list(cols), "column", "n_bad")


def drop_value(df: DataFrame, col: str, value) -> DataFrame:
    """Remove rows whose ``col`` equals ``value``; rows with NULL in ``col`` are kept."""
    return df.where(~F.col(col).eqNullSafe(F.lit(value)))


def rows_equal(df: DataFrame, col: str, value) -> DataFrame:
    """Rows whose ``col`` equals ``value`` (inspection)."""
    return df.where(F.col(col) == F.lit(value))


def merge_categories(df: DataFrame, col: str, mapping: Mapping[str, str], out: str | None = None) -> DataFrame:
    """Recode ``col`` by an explicit old → new map; values not in the map stay as they are."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(out or col, F.coalesce(F.try_element_at(m, F.col(col)), F.col(col)))


def merge_tail(df: DataFrame, col: str, min_count: int, other: str = "Other", out: str | None = None) -> DataFrame:
    """Replace every category with fewer than ``min_count`` rows by ``other``.

    Counts are a grouped aggregate (one row per category); the tail list is joined back.
    """
    tail = (
        df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < min_count)
        .select(F.col(col).alias("_tail_value"), F.lit(True).alias("_is_tail"))
    )
    j = df.join(tail, F.col(col) == F.col("_tail_value"), "left")
    return j.withColumn(out or col, F.when(F.col("_is_tail"), F.lit(other)).otherwise(F.col(col))).drop(
        "_tail_value", "_is_tail"
    )


def label_codes(df: DataFrame, col: str, code: str = "code") -> DataFrame:
    """The label dictionary: distinct labels with codes 0..m-1 in sorted label order."""
    return dense_codes(df, col, name=code)


def label_encode(df: DataFrame, col: str, code: str = "code", codes: DataFrame | None = None) -> DataFrame:
    """Add ``code`` = position of ``col`` among the sorted distinct labels (NULL stays NULL)."""
    codes = codes if codes is not None else label_codes(df, col, code)
    small = codes.select(F.col(col).alias("_lbl"), F.col(code))
    return df.join(small, F.col(col) == F.col("_lbl"), "left").drop("_lbl")


def label_decode(df: DataFrame, code: str, codes: DataFrame, label: str) -> DataFrame:
    """Inverse of :func:`label_encode` using the same dictionary."""
    small = codes.select(F.col(code).alias("_code"), F.col(label).alias(label))
    return df.join(small, F.col(code) == F.col("_code"), "left").drop("_code")
