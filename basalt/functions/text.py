"""Scalar string/date expressions used by the cleaning and relational operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basalt.functions.vectors import as_col


def strip_and_cast(c: str | Column, chars: str = "%", to: str = "double", strict: bool = False) -> Column:
    """Remove every character of ``chars`` and cast to ``to``.

    ``strict=False`` uses ``try_cast`` (bad text becomes NULL); ``strict=True`` uses a plain
    ANSI cast, which raises on the first bad cell, like the pandas ``astype`` it replaces.
    """
    cls = "[" + "".join("\\" + ch if ch in "\\^]-[" else ch for ch in chars) + "]"
    cleaned = F.regexp_replace(as_col(c), cls, "")
    return cleaned.cast(to) if strict else cleaned.try_cast(to)


def first_word(c: str | Column) -> Column:
    return F.split(as_col(c), " ").getItem(0)


def second_word(c: str | Column) -> Column:
    return F.element_at(F.split(as_col(c), " "), 2)


def initial(c: str | Column) -> Column:
    """Upper-cased first character (``SUBSTR(UPPER(x), 1, 1)``)."""
    return F.substring(F.upper(as_col(c)), 1, 1)


def starts_with_ci(c: str | Column, prefix: str) -> Column:
    """Case-insensitive prefix test; ``LIKE`` is case sensitive, so compare upper-cased."""
    return F.upper(as_col(c)).startswith(prefix.upper())


def day_diff(later: str | Column, earlier: str | Column) -> Column:
    """Whole calendar days from ``earlier`` to ``later`` (negative when later < earlier)."""
    return F.datediff(F.to_date(as_col(later)), F.to_date(as_col(earlier)))
