"""Joins of a build whose sides grow with the tables send none through the driver."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.operators.quality import Check, violations, run_checks
from tessera.plans import gold
from tessera.plans.mart_states import items_state, times_state
from tessera.session import scratch_dir
from tessera.sources.partitioned import PartitionedTable

D = dt.date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def orders(spark):
    return spark.createDataFrame([("1", "S1", D(2020, 1, 1)), (None, "S1", D(2020, 1, 1)), ("2", "S2", None)],
                                 "orderid string, storeid string, orderdate date")


def test_mart_states_are_joined_by_shuffles(spark):
    items = spark.createDataFrame([("1", "a"), ("1", "a"), ("3", "b"), (None, "c")], "orderid string, itemname string")
    counts = items_state(orders(spark), items)
    assert "BroadcastExchange" not in plan(counts)
    assert [tuple(r) for r in counts.collect()] == [(D(2020, 1, 1), "a", 2)]
    at = dt.datetime(2020, 1, 1)
    status = spark.createDataFrame([("1", "Submitted", at), ("1", "Delivered", at + dt.timedelta(days=1)), (None, "Submitted", at)],
                                   "orderid string, status string, statustimestamp timestamp_ntz")
    times = times_state(orders(spark), status)
    assert "BroadcastExchange" not in plan(times)
    assert [(r["storeid"], r["n_rows"], int(r["total"])) for r in times.collect()] == [("S1", 1, 86_400_000_000)]


def test_members_and_parents_are_joined_by_shuffles(spark):
    day = D(2020, 1, 1)
    stg = spark.createDataFrame([("1", "m", None, day), ("2", "x", "c", day), ("3", None, None, None)],
                                "orderid string, memberid string, campaignid string, orderdate date").withColumn("insert_date", F.lit(1))
    members = spark.createDataFrame([("m", "name", "t", day, day)], "memberid string, membername string, membershiptype string, joindate date, expirationdate date")
    campaigns = spark.createDataFrame([("c", "Gold", day, day)], "campaignid string, targetaudience string, campaignstartdate date, campaignenddate date")
    built = gold.build_orders(stg, members, campaigns)
    assert plan(built).count("BroadcastExchange") <= 1  # the campaigns
    assert sorted((r["orderid"], r["membername"], r["targetaudience"]) for r in built.collect()) == [
        ("1", "name", None), ("2", None, "Gold"), ("3", None, None)]
    check = Check("silver", "stg_orders", "relationships", "memberid", "error", {"to": "stg_members", "field": "memberid"})
    tables = {"stg_orders": stg, "stg_members": members}
    summary = run_checks(tables.get, [check])
    assert "BroadcastExchange" not in plan(summary)
    assert [r["failures"] for r in summary.collect()] == [1] == [violations(check, tables.get).count()]


def test_a_merge_sends_no_keys_through_the_driver(spark, monkeypatch):
    table = PartitionedTable(spark, scratch_dir(spark, "t-driver"), "order_year", lambda df: df.withColumn("order_year", F.year("orderdate")))
    schema = "orderid string, orderdate date, total decimal(10,2)"
    table.overwrite(spark.createDataFrame([("1", D(2020, 1, 1), Decimal(1)), ("2", D(2021, 1, 1), Decimal(1))], schema))
    plans, write = [], PartitionedTable._write
    monkeypatch.setattr(PartitionedTable, "_write", lambda self, rows, head: (plans.append(plan(rows)), write(self, rows, head))[1])
    joins, join = [], type(table.read()).join
    monkeypatch.setattr(type(table.read()), "join", lambda self, *a, **b: (out := join(self, *a, **b), joins.append(plan(out)))[0])
    table.merge(spark.createDataFrame([("1", D(2021, 5, 1), Decimal(2))], schema), "orderid", "orderdate")
    assert len(plans) == len(joins) == 2
    assert not any("BroadcastExchange" in p for p in plans + joins)
    assert sorted((r["orderid"], r["order_year"]) for r in table.read().collect()) == [("1", 2021), ("2", 2021)]


def test_high_water_needs_no_scan_of_all_partitions(spark):
    table = PartitionedTable(spark, scratch_dir(spark, "t-high"), "order_year", lambda df: df.withColumn("order_year", F.year("orderdate")))
    schema = "orderid string, orderdate date"
    table.overwrite(spark.createDataFrame([("1", D(2020, 1, 1)), ("2", None), ("3", D(2019, 1, 1))], schema))
    assert sorted(table.partition_values(table.current_version()), key=str) == [2019, 2020, None]
