"""Registered queries: profiling and cleaning of the test tables.

NULLs are injected with ``nullif`` where a check needs some (the test tables have none).
Doubles are rounded to 6 decimals in both the query and its oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basalt.operators import clean, profile
from basalt.operators import relational as rel
from basalt.plans.registry import Tables, query

LINE_NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _round(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _describe_sql():
    parts = []
    for c in LINE_NUMS:
        parts.append(
            f"SELECT '{c}' AS column, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std, "
            f"ROUND(MIN({c}), 6) AS min, ROUND(QUANTILE_CONT({c}, 0.25), 6) AS p25, ROUND(QUANTILE_CONT({c}, 0.5), 6) AS p50, "
            f"ROUND(QUANTILE_CONT({c}, 0.75), 6) AS p75, ROUND(MAX({c}), 6) AS max FROM lineitem"
        )
    return " UNION ALL ".join(parts)


@query("describe_numeric", _describe_sql())
def describe_numeric(spark, sf_dir):
    return _round(profile.describe_numeric(Tables(spark, sf_dir).lineitem, LINE_NUMS, exact=True))


def _orders_with_nulls(t):
    o = t.orders
    return o.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("o_orderpriority"),
        "o_totalprice",
    )


def _null_counts_sql():
    cte = (
        "WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS o_orderstatus, "
        "nullif(o_orderpriority, '1-URGENT') AS o_orderpriority, o_totalprice FROM orders) "
    )
    conds = {
        "o_orderkey": "o_orderkey IS NULL",
        "o_orderstatus": "o_orderstatus IS NULL",
        "o_orderpriority": "o_orderpriority IS NULL",
        "o_totalprice": "o_totalprice IS NULL OR isnan(o_totalprice)",
    }
    rows = [
        f"SELECT '{c}' AS column, COUNT(*) FILTER (WHERE {w}) AS n_null, COUNT(*) FILTER (WHERE {w}) > 0 AS has_null FROM o"
        for c, w in conds.items()
    ]
    return cte + " UNION ALL ".join(rows)


@query("null_counts", _null_counts_sql())
def null_counts(spark, sf_dir):
    return profile.null_counts(_orders_with_nulls(Tables(spark, sf_dir)))


@query(
    "negative_counts",
    """
    SELECT 'c_custkey' AS column, COUNT(*) FILTER (WHERE c_custkey < 0) AS n_negative,
           COUNT(*) FILTER (WHERE c_custkey < 0) > 0 AS has_negative FROM customer
    UNION ALL SELECT 'c_nationkey', COUNT(*) FILTER (WHERE c_nationkey < 0), COUNT(*) FILTER (WHERE c_nationkey < 0) > 0 FROM customer
    UNION ALL SELECT 'c_acctbal', COUNT(*) FILTER (WHERE c_acctbal < 0), COUNT(*) FILTER (WHERE c_acctbal < 0) > 0 FROM customer
    """,
)
def negative_counts(spark, sf_dir):
    return profile.negative_counts(Tables(spark, sf_dir).customer)


@query(
    "key_uniqueness",
    """
    SELECT COUNT(*) AS n_rows, (SELECT COUNT(*) FROM (SELECT DISTINCT o_custkey FROM orders)) AS n_distinct_keys,
           COUNT(*) = (SELECT COUNT(*) FROM (SELECT DISTINCT o_custkey FROM orders)) AS is_unique
    FROM orders
    """,
)
def key_uniqueness(spark, sf_dir):
    return profile.key_uniqueness(Tables(spark, sf_dir).orders, ["o_custkey"])


@query(
    "value_counts",
    """
    SELECT o_orderpriority, COUNT(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL
    GROUP BY o_orderpriority ORDER BY count DESC, o_orderpriority
    """,
)
def value_counts(spark, sf_dir):
    return profile.value_counts(Tables(spark, sf_dir).orders, "o_orderpriority")


@query("row_counts", "SELECT COUNT(*) AS n_rows, 11 AS n_cols FROM lineitem")
def row_counts(spark, sf_dir):
    return profile.row_col_counts(Tables(spark, sf_dir).lineitem)


@query("preview_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 50")
def preview_rows(spark, sf_dir):
    return rel.head_rows(Tables(spark, sf_dir).orders, ["o_orderkey"], 50)


@query("preview_tail_rows", "SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 50")
def preview_tail_rows(spark, sf_dir):
    return rel.tail_rows(Tables(spark, sf_dir).orders, ["o_orderkey"], 50)


@query(
    "parse_percent",
    """
    SELECT l_orderkey, l_linenumber, discount_text,
           TRY_CAST(regexp_replace(discount_text, '[%]', '', 'g') AS DOUBLE) AS discount_pct
    FROM (SELECT l_orderkey, l_linenumber,
                 CAST(CAST(l_discount * 100 AS DECIMAL(8,2)) AS VARCHAR) || '%' AS discount_text FROM lineitem)
    """,
)
def parse_percent(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    raw = li.select(
        "l_orderkey", "l_linenumber",
        F.concat((F.col("l_discount") * 100).cast("decimal(8,2)").cast("string"), F.lit("%")).alias("discount_text"),
    )
    return clean.parse_number(raw.withColumn("discount_pct", F.col("discount_text")), ["discount_pct"], strip="%")


@query(
    "parse_currency",
    """
    SELECT o_orderkey, price_text, TRY_CAST(regexp_replace(price_text, '[$]', '', 'g') AS DOUBLE) AS price
    FROM (SELECT o_orderkey, '$' || CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS price_text FROM orders)
    """,
)
def parse_currency(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    raw = o.select("o_orderkey", F.concat(F.lit("$"), F.col("o_totalprice").cast("decimal(14,2)").cast("string")).alias("price_text"))
    return clean.parse_number(raw.withColumn("price", F.col("price_text")), ["price"], strip="$")


def _tax_with_nulls(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.nullif("l_tax", F.lit(0.08)).alias("l_tax"))


@query(
    "drop_zero_rows",
    """
    SELECT l_orderkey, l_linenumber, l_tax FROM
      (SELECT l_orderkey, l_linenumber, nullif(l_tax, CAST(0.08 AS DOUBLE)) AS l_tax FROM lineitem)
    WHERE l_tax IS DISTINCT FROM 0
    """,
)
def drop_zero_rows(spark, sf_dir):
    return clean.drop_value(_tax_with_nulls(Tables(spark, sf_dir)), "l_tax", 0.0)


@query(
    "zero_rows",
    """
    SELECT l_orderkey, l_linenumber, l_tax FROM
      (SELECT l_orderkey, l_linenumber, nullif(l_tax, CAST(0.08 AS DOUBLE)) AS l_tax FROM lineitem)
    WHERE l_tax = 0
    """,
)
def zero_rows(spark, sf_dir):
    return clean.rows_equal(_tax_with_nulls(Tables(spark, sf_dir)), "l_tax", 0.0)


@query(
    "label_encode",
    "SELECT p_partkey, p_type, CAST(DENSE_RANK() OVER (ORDER BY p_type) - 1 AS BIGINT) AS type_code FROM part",
)
def label_encode(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_type")
    return clean.label_encode(p, "p_type", code="type_code")


MERGED_BRANDS = {f"Brand#{i}": "Other" for i in range(1, 6)}


@query(
    "merge_categories",
    """
    SELECT CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5') THEN 'Other' ELSE p_brand END AS brand,
           COUNT(*) AS n
    FROM part GROUP BY brand ORDER BY n DESC, brand
    """,
)
def merge_categories(spark, sf_dir):
    p = clean.merge_categories(Tables(spark, sf_dir).part, "p_brand", MERGED_BRANDS, out="brand")
    return p.groupBy("brand").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "brand")


@query(
    "merge_tail_categories",
    """
    WITH c AS (SELECT p_brand, COUNT(*) AS k FROM part GROUP BY p_brand)
    SELECT CASE WHEN c.k < (SELECT CAST(floor(AVG(k)) AS BIGINT) FROM c) THEN 'Other' ELSE p.p_brand END AS brand, COUNT(*) AS n
    FROM part p JOIN c ON p.p_brand = c.p_brand GROUP BY brand ORDER BY n DESC, brand
    """,
)
def merge_tail_categories(spark, sf_dir):
    """Brands with fewer parts than the average brand become one category."""
    part = Tables(spark, sf_dir).part
    least = part.groupBy("p_brand").count().agg(F.floor(F.avg("count"))).first()[0]
    p = clean.merge_tail(part, "p_brand", min_count=least, out="brand")
    return p.groupBy("brand").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "brand")


def _corr_sql():
    from itertools import combinations

    rows = [
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(CORR({a}, {b}), 6) AS r FROM l"
        for a, b in combinations(LINE_NUMS, 2)
    ]
    cte = "WITH l AS (SELECT l_quantity, l_extendedprice, nullif(l_discount, CAST(0.05 AS DOUBLE)) AS l_discount, l_tax FROM lineitem) "
    return cte + " UNION ALL ".join(rows)


@query("correlation_pairs", _corr_sql())
def correlation_pairs(spark, sf_dir):
    """Correlations with missing values: some discounts are made NaN, which a pair skips."""
    nan = F.lit(float("nan"))
    li = Tables(spark, sf_dir).lineitem.select(*LINE_NUMS).withColumn("l_discount", F.when(F.col("l_discount") == 0.05, nan).otherwise(F.col("l_discount")))
    return _round(profile.correlation_pairs(li, LINE_NUMS))


@query("correlation_gram", _corr_sql())
def correlation_gram(spark, sf_dir):
    """The same correlations from masked Gram matrices, the form for wide tables."""
    null = F.lit(None).cast("double")
    li = Tables(spark, sf_dir).lineitem.select(*LINE_NUMS).withColumn("l_discount", F.when(F.col("l_discount") == 0.05, null).otherwise(F.col("l_discount")))
    return _round(profile.correlation_pairs(li, LINE_NUMS, method="gram"))


@query("schema_report", 'SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS "column" FROM (DESCRIBE orders)')
def schema_report(spark, sf_dir):
    """Position and name of each column of the orders, from metadata alone."""
    return profile.schema_report(Tables(spark, sf_dir).orders).select("position", "column")


@query(
    "majority_accuracy",
    """
    SELECT ROUND(MAX(c) FILTER (WHERE p IS NOT NULL) * 100.0 / SUM(c), 2) AS majority_pct
    FROM (SELECT CASE WHEN o_orderpriority < '4' THEN NULL ELSE o_orderpriority END AS p, COUNT(*) AS c FROM orders GROUP BY p)
    """,
)
def majority_accuracy(spark, sf_dir):
    """Most orders have no label here, so NULL is the largest group."""
    o = Tables(spark, sf_dir).orders.select(F.when(F.col("o_orderpriority") >= "4", F.col("o_orderpriority")).alias("p"))
    return profile.majority_accuracy(o, "p")


ORDER_COLS = ["n_lines", "line_total", "line_qty", "o_totalprice"]
_ORDER_SQL = """
WITH a AS (SELECT l_orderkey, COUNT(*) AS n_lines, SUM(l_extendedprice) AS line_total, SUM(l_quantity) AS line_qty
           FROM lineitem GROUP BY l_orderkey),
f AS (SELECT a.*, o_totalprice FROM a JOIN orders ON l_orderkey = o_orderkey)
"""


def _order_frame(t):
    per = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_extendedprice").alias("line_total"), F.sum("l_quantity").alias("line_qty")
    )
    return per.join(t.orders.select("o_orderkey", "o_totalprice"), F.col("l_orderkey") == F.col("o_orderkey"))


def _order_corr_sql(strong: bool):
    from itertools import combinations

    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(CORR({a}, {b}), 6) AS r FROM f" for a, b in combinations(ORDER_COLS, 2)
    )
    return _ORDER_SQL + (f"SELECT * FROM ({rows}) WHERE abs(r) > 0.4 AND abs(r) < 1" if strong else rows)


@query("order_correlation_pairs", _order_corr_sql(False))
def order_correlation_pairs(spark, sf_dir):
    """Correlations between per-order line aggregates and the order total."""
    return _round(profile.correlation_pairs(_order_frame(Tables(spark, sf_dir)), ORDER_COLS))


@query("order_strong_correlations", _order_corr_sql(True))
def order_strong_correlations(spark, sf_dir):
    return profile.strong_correlations(order_correlation_pairs(spark, sf_dir))
