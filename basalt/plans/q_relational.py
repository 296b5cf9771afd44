"""Registered queries: SQL questions on the order schema and the catalog report.

Stand-ins: part words → employee first/last names, part.p_type → product line,
lineitem.l_quantity × part.p_retailprice → ordered value, orders.o_orderstatus 'P' →
"in process", lineitem.l_shipdate / orders.o_orderdate → due / done dates.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basalt.operators import relational as rel
from basalt.plans.registry import Tables, query
from basalt.sources.tables import TEST_TABLES, table_row_counts


def _names(t: Tables):
    """part.p_name 'small ring' → first_name 'small', last_name 'ring'."""
    return t.part.select(
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("first_name"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("last_name"),
    )


@query(
    "revenue_by_product_line",
    """
    SELECT p_type, ROUND(SUM(l_quantity * p_retailprice), 2) AS total_value
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_type
    ORDER BY total_value DESC, p_type
    """,
)
def revenue_by_product_line(spark, sf_dir):
    t = Tables(spark, sf_dir)
    total = rel.sum_product_by(t.lineitem, t.part, "l_partkey", "p_partkey", "p_type", "l_quantity", "p_retailprice")
    return total.withColumn("total_value", F.round("total_value", 2))


@query(
    "name_prefix_count",
    """
    SELECT COUNT(*) AS n FROM part
    WHERE upper(split_part(p_name, ' ', 1)) LIKE 'P%' OR upper(split_part(p_name, ' ', 2)) LIKE 'P%'
    """,
)
def name_prefix_count(spark, sf_dir):
    return rel.name_prefix_count(_names(Tables(spark, sf_dir)), ["first_name", "last_name"], "P")


@query(
    "initial_letter_counts",
    """
    SELECT substr(upper(split_part(p_name, ' ', 2)), 1, 1) AS letter, COUNT(*) AS n
    FROM part GROUP BY letter HAVING COUNT(*) > 1 ORDER BY n DESC, letter
    """,
)
def initial_letter_counts(spark, sf_dir):
    return rel.initial_counts(_names(Tables(spark, sf_dir)), "last_name", more_than=1)


@query(
    "initial_letter_many",
    """
    SELECT COUNT(*) AS n_letters FROM (
      SELECT substr(upper(split_part(p_name, ' ', 2)), 1, 1) AS letter
      FROM part GROUP BY letter HAVING COUNT(*) > 1) t
    """,
)
def initial_letter_many(spark, sf_dir):
    return rel.letters_with_many(_names(Tables(spark, sf_dir)), "last_name", more_than=1)


@query("open_orders_count", "SELECT COUNT(*) AS n FROM orders WHERE lower(o_orderstatus) = 'p'")
def open_orders_count(spark, sf_dir):
    return rel.status_count(Tables(spark, sf_dir).orders, "o_orderstatus", "P")


@query(
    "short_slack_count",
    """
    SELECT COUNT(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) < 2
    """,
)
def short_slack_count(spark, sf_dir):
    t = Tables(spark, sf_dir)
    joined = t.lineitem.select("l_orderkey", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return rel.slack_days_count(joined, due="l_shipdate", done="o_orderdate", days=2)


@query(
    "top_customers_products",
    """
    WITH top AS (SELECT DISTINCT c_custkey, c_name FROM customer ORDER BY c_name, c_custkey LIMIT 3),
         co AS (SELECT c_name, o_orderkey FROM orders JOIN top ON o_custkey = c_custkey)
    SELECT DISTINCT c_name, p_partkey, p_name
    FROM lineitem JOIN co ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    """,
)
def top_customers_products(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return rel.first_customers_products(t.customer, t.orders, t.lineitem, t.part, k=3)


@query(
    "table_row_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in sorted(TEST_TABLES))
    + " ORDER BY table_name",
)
def table_row_counts_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return table_row_counts({n: getattr(t, n) for n in TEST_TABLES})
