"""Registry of named queries over the test tables, each with an optional DuckDB oracle.

A query is a function ``(spark, sf_dir) -> DataFrame`` that composes library operators on
the Parquet tables of ``sf_dir``. Its oracle is ANSI SQL over the same tables, used by the
correctness check; queries whose semantics are iterative or ML-based register none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basalt.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with an optional oracle SQL string."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


class Tables:
    """Lazy accessor ``t.lineitem`` → DataFrame of ``{sf_dir}/lineitem.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self._spark, self._dir, name)
