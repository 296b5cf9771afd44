"""Every registered query with an oracle matches DuckDB on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from basalt.plans import all_oracles, all_queries
from basalt.sources.tables import TEST_TABLES
from tools.check_oracle import rows_of

SF = "/root/testdata/sf0.001"
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(all_queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = all_queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLES[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert op not in plan, f"{name} plans a {op}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["p_type", "total_value"]
