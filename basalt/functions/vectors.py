"""Column expressions over ARRAY<DOUBLE> vectors.

All of these are built-in higher-order functions (``transform``, ``zip_with``, ``aggregate``): they
run in the JVM, interpreted inside the generated code of their stage (their lambdas are not
compiled), without Python per row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double_array(c: str | Column) -> Column:
    """Cast any numeric array (e.g. ARRAY<FLOAT>) to ARRAY<DOUBLE>."""
    return as_col(c).cast("array<double>")


def _sql_double(v: float) -> str:
    v = float(v)
    if math.isnan(v) or math.isinf(v):
        return f"CAST('{v}' AS DOUBLE)"
    return f"{v!r}D"


def _sql_vector(values: Sequence[float]) -> str:
    return "array(" + ", ".join(_sql_double(v) for v in values) + ")" if len(values) else "CAST(array() AS ARRAY<DOUBLE>)"


def lit_vector(values: Sequence[float]) -> Column:
    """A literal ARRAY<DOUBLE> column.

    Built from one SQL expression string (one call into the JVM, folded to a single
    literal by the optimizer) instead of one ``lit`` per element: per-iteration plans
    in the iterative operators stay cheap to build and analyze.
    """
    return F.expr(_sql_vector(values))


def lit_matrix(rows: Sequence[Sequence[float]]) -> Column:
    """A literal ARRAY<ARRAY<DOUBLE>> column (k small rows, e.g. centroids)."""
    return F.expr("array(" + ", ".join(_sql_vector(r) for r in rows) + ")")


def vsum(c: str | Column) -> Column:
    """Sum of the elements of one array."""
    return F.aggregate(as_col(c), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a: str | Column, b: str | Column) -> Column:
    """Dot product of two equal-length arrays."""
    return vsum(F.zip_with(as_col(a), as_col(b), lambda x, y: x * y))


def sq_dist(a: str | Column, b: str | Column) -> Column:
    """Squared Euclidean distance of two equal-length arrays."""
    return vsum(F.zip_with(as_col(a), as_col(b), lambda x, y: (x - y) * (x - y)))


def of_width(c: str | Column, d: int) -> Column:
    """The array itself, or NULL; an array of another length than ``d`` fails the job (``zip_with`` would
    pad it with NULL)."""
    x = to_double_array(c)
    return F.when(x.isNull() | (F.size(x) == d), x).otherwise(F.raise_error(F.lit(f"vector width is not {d}")).cast("array<double>"))


def complete(c: str | Column) -> Column:
    """Whether a vector is there and has no NULL, NaN or infinite element."""
    x = as_col(c)
    return F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


def vadd(a: str | Column, b: str | Column) -> Column:
    """Sum of two equal-length arrays, element by element."""
    return F.zip_with(as_col(a), as_col(b), lambda x, y: x + y)


def vscale(a: str | Column, s: Column | float) -> Column:
    """The array times a number."""
    s = s if isinstance(s, Column) else F.lit(float(s))
    return F.transform(as_col(a), lambda x: x * s)


def sigmoid(z: Column) -> Column:
    """Logistic function. ``exp`` overflow gives +Infinity and then 0.0, not an error."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
