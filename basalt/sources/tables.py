"""Table sources: Parquet tables by name, catalog checks and exact row counts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table ``{base}/{name}.parquet``; the scan prunes columns and pushes filters."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, base: str, names: Sequence[str] = TEST_TABLES) -> dict[str, DataFrame]:
    """Read each table and register it as a temp view of the same name (``USE db; FROM t``)."""
    out = {}
    for n in names:
        df = read_table(spark, base, n)
        df.createOrReplaceTempView(n)
        out[n] = df
    return out


def database_exists(spark: SparkSession, name: str) -> bool:
    """Catalog check by parameter (never by building SQL text from the name)."""
    return spark.catalog.databaseExists(name)


def table_row_counts(tables: Mapping[str, DataFrame], name_col: str = "table_name", count_col: str = "row_count") -> DataFrame:
    """Exact row count of every table, ordered by table name.

    Each count is a column-free aggregate (Parquet answers it from footers/row groups);
    the per-table one-row results are unioned, so the whole report is one job.
    """
    if not tables:
        raise ValueError("no table given")
    parts = [
        df.agg(F.count(F.lit(1)).alias(count_col)).select(F.lit(n).alias(name_col), count_col)
        for n, df in sorted(tables.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(name_col)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def catalog_row_counts(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Row counts of every table and view that belongs to ``database``; if it is not given, of all that
    the session sees: the current database and its temporary views, which belong to no database.
    An empty report if there is none, or no such database."""
    empty = spark.createDataFrame([], "table_name STRING, row_count LONG")
    if database is not None and not database_exists(spark, database):
        return empty
    owned = [t for t in spark.catalog.listTables(database and _quoted(database)) if database is None or not t.isTemporary]
    tables = {t.name: spark.table(".".join(_quoted(x) for x in [*(t.namespace or []), t.name])) for t in owned}
    return table_row_counts(tables) if tables else empty


def analyze_tables(spark: SparkSession, database: str) -> None:
    """Count the rows of every table of a database and store the counts in the catalog."""
    for t in spark.catalog.listTables(_quoted(database)):
        if not t.isTemporary and t.tableType != "VIEW":
            spark.sql(f"ANALYZE TABLE {_quoted(database)}.{_quoted(t.name)} COMPUTE STATISTICS")


def stored_row_counts(spark: SparkSession, database: str, check: bool = False) -> DataFrame:
    """(table_name, stored_rows) as the catalog holds them, NULL where none are stored; no table is read.

    ``check`` adds ``row_count``, the exact count, and ``stale``: whether the stored one is missing or
    differs. A missing database, or one without tables, gives an empty report.
    """
    stored = []
    if database_exists(spark, database):
        for t in spark.catalog.listTables(_quoted(database)):
            if not t.isTemporary and t.tableType != "VIEW":
                facts = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(database)}.{_quoted(t.name)}").collect()}
                rows = re.search(r"(\d+) rows", facts.get("Statistics") or "")
                stored.append((t.name, int(rows.group(1)) if rows else None))
    out = spark.createDataFrame(sorted(stored), "table_name STRING, stored_rows LONG")
    if not check:
        return out
    exact = catalog_row_counts(spark, database)
    return out.join(exact, "table_name").withColumn("stale", ~F.col("stored_rows").eqNullSafe(F.col("row_count"))).orderBy("table_name")


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table over JDBC, read in ``num_partitions`` parallel range slices of
    ``partition_column`` (without a partition column the whole table is one task)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()
