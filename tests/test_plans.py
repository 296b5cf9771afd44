"""Plan checks: where Python runs and where not, filters reach the scan, broadcasts where bounded."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["revenue_by_product_line", "top_customers_products", "reciprocal_pairs", "kmeans_assign", "margin_score", "null_counts"],
)
def test_no_python_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow"):
        assert node not in plan


@pytest.mark.parametrize("name", ["kmeans_step", "logistic_step"])
def test_batch_sums_expand_no_array(spark, name):
    """Partial sums come from numpy batches: no row per coordinate is generated."""
    plan = _plan(E.queries()[name](spark, SF))
    assert "MapInArrow" in plan and "Generate" not in plan


def test_prefix_query_prunes_columns(spark):
    df = E.queries()["name_prefix_count"](spark, SF)
    plan = _plan(df)
    assert "ReadSchema: struct<p_name:string>" in plan


def test_top_customers_broadcasts_top_k(spark):
    df = E.queries()["top_customers_products"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan.lower()
    assert "TakeOrderedAndProject" in _plan(df) or "GlobalLimit" in plan


def test_filters_reach_the_scan(spark):
    from basalt.operators import clean
    from basalt.plans.registry import Tables

    t = Tables(spark, SF)
    plan = _plan(clean.rows_equal(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "P"))
    assert "EqualTo(o_orderstatus,P)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan
    # lower() hides the column from the scan: only the column list is pruned there
    plan = _plan(E.queries()["open_orders_count"](spark, SF))
    assert "ReadSchema: struct<o_orderstatus:string>" in plan


def test_grouped_sum_aggregates_below_the_join(spark):
    opt = E.queries()["revenue_by_product_line"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [l_partkey" in opt[opt.index("Join") :]
