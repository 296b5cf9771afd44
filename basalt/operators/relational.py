"""Relational questions on an order schema: filtered counts, grouped sums, top-k, joins.

Each function takes DataFrames and column names and returns a DataFrame. Joins are written
declaratively; Catalyst prunes columns and pushes filters to the Parquet scan, and AQE
picks broadcast vs. sort-merge at run time from measured sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.functions.text import day_diff, initial, starts_with_ci
from basalt.plans.joins import bounded_broadcast


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    """``SELECT COUNT(*) AS name FROM df WHERE condition`` (one row)."""
    return df.where(condition).agg(F.count(F.lit(1)).alias(name))


def name_prefix_count(df: DataFrame, cols: Sequence[str], prefix: str, name: str = "n") -> DataFrame:
    """Rows where any of ``cols`` starts with ``prefix``, ignoring case."""
    cond = None
    for c in cols:
        t = F.coalesce(starts_with_ci(c, prefix), F.lit(False))
        cond = t if cond is None else cond | t
    return count_where(df, cond, name)


def initial_counts(df: DataFrame, col: str, more_than: int = 1, letter: str = "letter", name: str = "n") -> DataFrame:
    """Rows per upper-cased initial of ``col``, keeping initials with more than ``more_than`` rows.

    Ordered by count descending, then initial (deterministic tie-break).
    """
    return (
        df.groupBy(initial(col).alias(letter))
        .agg(F.count(F.lit(1)).alias(name))
        .where(F.col(name) > more_than)
        .orderBy(F.col(name).desc(), F.col(letter))
    )


def letters_with_many(df: DataFrame, col: str, more_than: int = 1, name: str = "n_letters") -> DataFrame:
    """How many initials have more than ``more_than`` rows (the count the question asks for)."""
    return initial_counts(df, col, more_than).agg(F.count(F.lit(1)).alias(name))


def status_count(df: DataFrame, col: str, value: str, name: str = "n") -> DataFrame:
    """Case-insensitive equality count: ``lower(col) = lower(value)``."""
    return count_where(df, F.lower(F.col(col)) == value.lower(), name)


def slack_days_count(df: DataFrame, due: str, done: str, days: int = 2, name: str = "n") -> DataFrame:
    """Rows finished fewer than ``days`` calendar days before they were due.

    True day difference (late rows, with a negative difference, count; NULL dates drop out).
    """
    return count_where(df, day_diff(due, done) < days, name)


def sum_product_by(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    group: str,
    fact_value: str,
    dim_value: str,
    name: str = "total_value",
    exact_scale: int | None = None,
) -> DataFrame:
    """``SUM(fact_value * dim_value)`` of ``fact`` joined to ``dim``, grouped by a ``dim``
    column, largest first.

    ``dim_value`` is constant per ``dim_key``, so the fact side is first summed per join key
    (Σ q·p = Σ_key p·Σ q) with partial aggregation: one row per key and task reaches the join,
    and a hot key costs one row per task. The join carries no hint; the adaptive planner
    broadcasts the dimension if its bytes allow.

    ``exact_scale`` is for values that are decimals with that many places by nature: they are
    added as DECIMAL, so the result does not depend on the order of rows, and cast back to
    DOUBLE. Values with more places would be rounded first, hence it is off by default.
    """
    if exact_scale is not None:
        dec = f"decimal(18,{exact_scale})"
        fv, dv = F.col(fact_value).cast(dec), F.col(dim_value).cast(dec)
    else:
        fv, dv = F.col(fact_value), F.col(dim_value)
    per_key = fact.groupBy(F.col(fact_key).alias("_fkey")).agg(F.sum(fv).alias("_fsum"))
    joined = per_key.join(dim.select(dim_key, group, dv.alias("_dv")), F.col("_fkey") == F.col(dim_key))
    total = F.sum(F.col("_fsum") * F.col("_dv"))
    if exact_scale is not None:
        total = total.cast("double")
    return joined.groupBy(group).agg(total.alias(name)).orderBy(F.col(name).desc(), F.col(group))


def top_k_distinct(df: DataFrame, cols: Sequence[str], by: Sequence[str], k: int) -> DataFrame:
    """First ``k`` distinct ``cols`` rows in ``by`` order (``SELECT DISTINCT ... ORDER BY ... LIMIT k``).

    Planned as a TakeOrderedAndProject: each partition keeps its own top k, so only
    k rows per partition reach the final merge.
    """
    return df.select(*cols).distinct().orderBy(*by).limit(k)


def first_customers_products(
    customers: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    k: int = 3,
) -> DataFrame:
    """Every distinct (customer name, product key, product name) bought by the first ``k``
    customers in name order. Column names follow the order schema of the test tables.
    """
    top = top_k_distinct(customers, ["c_custkey", "c_name"], ["c_name", "c_custkey"], k)
    cust_orders = orders.select("o_orderkey", "o_custkey").join(
        bounded_broadcast(top), F.col("o_custkey") == F.col("c_custkey")
    ).select("c_name", "o_orderkey")
    # The orders of k customers are few in practice but not bounded: no hint here.
    picked = lines.select("l_orderkey", "l_partkey").join(cust_orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        picked.join(products.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
        .select("c_name", "p_partkey", "p_name")
        .distinct()
    )


def head_rows(df: DataFrame, key: Sequence[str], n: int = 50) -> DataFrame:
    """First ``n`` rows by ``key`` (pandas ``head`` needs an explicit order in Spark)."""
    return df.orderBy(*key).limit(n)


def tail_rows(df: DataFrame, key: Sequence[str], n: int = 50) -> DataFrame:
    """Last ``n`` rows by ``key``."""
    return df.orderBy(*[F.col(c).desc() for c in key]).limit(n)


def shuffled(df: DataFrame, key: Sequence[str], seed: int = 42, name: str = "shuffle_key") -> DataFrame:
    """A reproducible random permutation: order by ``name``, the md5 of the seed and the key."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]).cast("binary"))
    return df.withColumn(name, h).orderBy(name, *key)
