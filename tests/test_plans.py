"""Plan shape: pruning, pushdown, partial top-k before shuffles, no Python."""

from tessera.plans import bronze
from tessera.plans import landing_queries as lq
from tessera.plans.queries import layers
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_shuffle(spark):
    p = plan(layers(spark, SMALL).stg_orders)
    assert "WindowGroupLimit" in p


def test_marts_have_no_python_and_prune_columns(spark):
    L = layers(spark, SMALL)
    for df in (L.mart_popular_items, L.mart_spending_members, L.mart_gross_revenue,
               L.mart_order_processing_times):
        p = plan(df)
        assert "Python" not in p and "ArrowEval" not in p
    p = plan(L.mart_popular_items)
    assert "l_orderkey" in p and "l_extendedprice" not in p and "o_totalprice" not in p.split("ReadSchema")[-1]


def test_partition_prune_uses_partition_filters(spark):
    p = plan(lq.q_partition_prune(spark, SMALL))
    assert "PartitionFilters: [isnotnull(order_year" in p and "PushedFilters: [IsNotNull(orderdate), GreaterThanOrEqual(orderdate" in p


def test_popular_items_window_gets_group_limit(spark):
    p = plan(layers(spark, SMALL).mart_popular_items)
    assert p.count("WindowGroupLimit") >= 2


def test_status_texts_are_parsed_once(spark):
    rows = [("1", "Submitted", "05/01/2023 10:00:00"), ("2", "Submitted", None), ("3", "click", "2023-01-05"),
            ("4", "click", ""), (None, None, "6/1/2023 1:2:3"), ("1", "Submitted", "05/01/2023 10:00:00")]
    raw = spark.createDataFrame(rows, "orderid string, status string, statustimestamp string").selectExpr("*", "'f' source_name")
    df = bronze.base_order_status(raw)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == 1
    found = [(r.orderid, r.status, str(r.statustimestamp)) for r in df.collect()]
    assert sorted(found, key=str) == sorted([("1", "Submitted", "2023-01-05 10:00:00")] * 2 + [(None, None, "2023-01-06 01:02:03")], key=str)
