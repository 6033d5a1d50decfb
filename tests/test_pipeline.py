"""Materialised build: full run, then an incremental run on a new delivery."""

import shutil

import pytest
from pyspark.sql import functions as F

from tessera.contracts import CONTRACTS
from tessera.operators import quality as dq
from tessera.plans import marts, pipeline
from tessera.plans.layers import Layers
from tessera.session import local_fs_path, scratch_dir
from tessera.sources.testdata import raw_orders_relocation, raw_orders_revision, raw_tables
from tests.conftest import SMALL


def rows(df):
    return sorted(map(tuple, df.drop("insert_date").collect()), key=str)


def test_build_then_incremental(spark):
    root = scratch_dir(spark, "t-pipeline")
    run_build_then_incremental(spark, root, "year", [1999, 2000, 2001])


def test_month_grain_rewrites_only_recent_months(spark):
    root = scratch_dir(spark, "t-pipeline-month")
    raw = raw_tables(spark, SMALL)
    cutoff = F.lit("2000-01-01").cast("date")
    early = dict(raw, orders_raw=raw["orders_raw"].where(F.col("orderdate") < cutoff))
    pipeline.build(spark, early, root, fail_on_error=False, grain="month")
    nxt = dict(raw, orders_raw=raw_orders_revision(spark, SMALL))
    out = pipeline.build(spark, nxt, root, fail_on_error=False, grain="month")
    parts = out["versions"]["base_orders"]["rewritten_partitions"]
    assert parts[0] == 199912 and all(p >= 199912 for p in parts)
    wh = out["warehouse"]
    assert (wh.read("stg_orders").count()
            == Layers(nxt).base_orders.select("orderid").distinct().count())


def run_build_then_incremental(spark, root, grain, expect_parts):
    raw = raw_tables(spark, SMALL)
    early = dict(raw, orders_raw=raw["orders_raw"].where(F.col("orderdate") < F.lit("2000-01-01").cast("date")))
    with pytest.raises(dq.DataQualityError):  # silver tests fail on this data
        pipeline.build(spark, early, scratch_dir(spark, "t-pipeline-fail"), grain=grain)
    out = pipeline.build(spark, early, root, fail_on_error=False, grain=grain)
    wh = out["warehouse"]
    assert len(out["tests"]) == 37
    lazy = Layers(early)
    assert rows(wh.read("mart_popular_items")) == rows(lazy.mart_popular_items)

    # Next delivery: incremental models merge rows at/after the high-water mark.
    nxt = dict(raw, orders_raw=raw_orders_revision(spark, SMALL))
    out2 = pipeline.build(spark, nxt, root, fail_on_error=False, grain=grain)
    assert out2["versions"]["build_orders"]["rewritten_partitions"] == expect_parts
    assert out2["versions"]["mart_gross_revenue"] == out["versions"]["mart_gross_revenue"] + 1
    built = wh.read("base_orders")
    target = lazy.base_orders
    hw = target.agg(F.max("orderdate")).first()[0]
    new = Layers(nxt).base_orders.where(F.col("orderdate") >= F.lit(hw))
    expect = target.join(new.select("orderid"), "orderid", "left_anti").unionByName(new)
    assert rows(built) == rows(expect)
    # bronze keeps re-sent copies; gold has one row per order
    assert built.select("orderid").distinct().count() == wh.read("build_orders").count()
    m = spark.read.parquet(f"{root}/_metrics/incremental_loads").collect()
    # one row per incremental run of base_orders
    assert len(m) == 1 and {r["model"] for r in m} == {"base_orders"}
    assert all(r["late_rows"] > 0 for r in m)


def test_partition_high_water_reads_newest_partition_only(spark):
    root = scratch_dir(spark, "t-pipeline-hw")
    raw = raw_tables(spark, SMALL)
    out = pipeline.build(spark, raw, root, fail_on_error=False)
    wh = out["warehouse"]
    expect = wh.read("stg_orders").agg(F.max("orderdate")).first()[0]
    assert wh.high_water("stg_orders") == expect
    top = wh.table("stg_orders").read().where(F.col("order_year") == expect.year)
    plan = top.agg(F.max("orderdate"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan


def test_select_builds_only_downstream_models(spark):
    assert pipeline.downstream(["base_orders"]) == {
        "base_orders", "stg_orders", "build_orders", "mart_gross_revenue", "mart_popular_items",
        "mart_spending_members", "mart_order_processing_times"}
    root = scratch_dir(spark, "t-pipeline-select")
    raw = raw_tables(spark, SMALL)
    with pytest.raises(ValueError):
        pipeline.build(spark, raw, root, select=["base_orders"], fail_on_error=False)
    first = pipeline.build(spark, raw, root, fail_on_error=False)
    nxt = dict(raw, orders_raw=raw_orders_revision(spark, SMALL))
    out = pipeline.build(spark, nxt, root, fail_on_error=False, select=["base_orders"])
    assert set(out["versions"]) == pipeline.downstream(["base_orders"])
    assert out["versions"]["mart_gross_revenue"] == first["versions"]["mart_gross_revenue"] + 1
    assert {t["model"] for t in out["tests"]} <= pipeline.downstream(["base_orders"])
    members = first["warehouse"].table("stg_members")
    assert members.current_version() == first["versions"]["stg_members"]  # untouched


def test_rejects_are_written_by_the_tasks_that_scan(spark, monkeypatch):
    """Bad cells of several partitions: no single task reads the raw tables."""
    monkeypatch.setattr(pipeline, "LAYERS", ())
    root = scratch_dir(spark, "t-pipeline-rejects")
    raw = raw_tables(spark, SMALL)
    status = raw["order_status_raw"]
    bad = status.limit(40).withColumn("statustimestamp", F.lit("no time")).repartition(4)
    raw["order_status_raw"] = status.unionByName(bad)
    pipeline.build(spark, raw, root)
    rejects = spark.read.parquet(f"{root}/_rejects/bronze")
    assert rejects.where("cell = 'no time'").count() == 40
    assert len(rejects.inputFiles()) >= 4


# ---------------------------------------------------------------- increments

def deliveries(spark):
    """Later ones move orders to other months and stores and blank totals."""
    raw = raw_tables(spark, SMALL)
    early = raw["orders_raw"].where(F.col("orderdate") < F.lit("2000-01-01").cast("date"))
    return [dict(raw, orders_raw=o) for o in (early, raw_orders_revision(spark, SMALL), raw_orders_relocation(spark, SMALL))]


@pytest.fixture(scope="module")
def built(spark):
    """A warehouse after the first delivery."""
    root = scratch_dir(spark, "t-built")
    pipeline.build(spark, deliveries(spark)[0], root, fail_on_error=False, raw_versions=states(0))
    return root


def states(day):
    return {t: "1" for t in CONTRACTS} | {"orders_raw": str(day)}


def copy_of(spark, root, name):
    """Commits name folders relative to the warehouse, so it can be copied."""
    new = local_fs_path(scratch_dir(spark, name))
    shutil.copytree(local_fs_path(root), new, dirs_exist_ok=True)
    return new


MARTS = ("mart_gross_revenue", "mart_popular_items", "mart_spending_members", "mart_order_processing_times")


def test_marts_follow_the_changed_orders(spark, monkeypatch, built):
    """Each delivery changes dates, stores and totals of earlier orders: the
    marts equal those of all orders, and no mart reads all orders again."""
    root = copy_of(spark, built, "t-retract")
    full_states = []
    for name, mart in pipeline.STATES.items():
        def state(orders, *others, mart=mart, name=name):
            full_states.append((name, "_sign" in orders.columns))
            return mart.state(orders, *others)
        monkeypatch.setitem(pipeline.STATES, name, pipeline.STATES[name].__class__(**{**mart.__dict__, "state": state}))
    for day, raw in enumerate(deliveries(spark)[1:], 1):
        full_states.clear()
        out = pipeline.build(spark, raw, root, fail_on_error=False, raw_versions=states(day))
        wh = out["warehouse"]
        assert sorted(full_states) == sorted((m, True) for m in MARTS)
        orders = wh.read("build_orders")
        lazy = {"mart_gross_revenue": marts.mart_gross_revenue(orders),
                "mart_popular_items": marts.mart_popular_items(orders, wh.read("build_order_items")),
                "mart_spending_members": marts.mart_spending_members(orders),
                "mart_order_processing_times": marts.mart_order_processing_times(orders, wh.read("build_order_status"))}
        for name in MARTS:
            assert rows(wh.read(name)) == rows(lazy[name]), (day, name)
        assert len(out["tests"]) == 37
        known = {(t["model"], t["test_name"], t["column_name"]): t["failures"] for t in out["tests"]}
        fresh = {(r["model"], r["test_name"], r["column_name"]): r["failures"] for r in dq.run_checks(wh.read).collect()}
        assert known == fresh
    models = wh.published()["models"]
    again = pipeline.build(spark, raw, root, fail_on_error=False, raw_versions=states(2))
    assert wh.published()["models"] == models and len(again["tests"]) == 37  # nothing was delivered: nothing is built


def test_failing_tests_publish_nothing_of_their_layer(spark, built):
    root = copy_of(spark, built, "t-audit")
    second, wh = deliveries(spark)[1], pipeline.Warehouse(spark, root)
    silver, reader = rows(wh.read("stg_orders")), wh.read("stg_orders")
    before = wh.published()["models"]
    with pytest.raises(dq.DataQualityError):
        pipeline.build(spark, second, root, raw_versions=states(1))  # silver tests fail on this data
    now = pipeline.Warehouse(spark, root)
    after = now.published()["models"]
    assert after["base_orders"] > before["base_orders"]  # bronze only warns
    assert {m: v for m, v in after.items() if not m.startswith("base_")} == {m: v for m, v in before.items() if not m.startswith("base_")}
    assert rows(now.read("stg_orders")) == silver == rows(reader)
    assert now.table("stg_orders").current_version() > after["stg_orders"]  # written, never current
    out = pipeline.build(spark, second, root, fail_on_error=False, raw_versions=states(1))
    lazy = pipeline.Warehouse(spark, root)
    assert lazy.read("stg_orders").count() == lazy.read("base_orders").select("orderid").distinct().count()
    assert rows(lazy.read("mart_gross_revenue")) == rows(marts.mart_gross_revenue(lazy.read("build_orders")))
    assert out["versions"]["build_orders"]["rewritten_partitions"]


def test_a_failed_build_leaves_marts_and_a_retry_repairs(spark, monkeypatch, built):
    root = copy_of(spark, built, "t-dead-build")
    second, wh = deliveries(spark)[1], pipeline.Warehouse(spark, root)
    revenue = rows(wh.read("mart_gross_revenue"))
    with monkeypatch.context() as m:
        m.setattr(pipeline, "build_mart", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            pipeline.build(spark, second, root, fail_on_error=False, raw_versions=states(1))
    assert rows(pipeline.Warehouse(spark, root).read("mart_gross_revenue")) == revenue
    wh = pipeline.build(spark, second, root, fail_on_error=False, raw_versions=states(1))["warehouse"]
    for name, lazy in (("mart_gross_revenue", marts.mart_gross_revenue), ("mart_spending_members", marts.mart_spending_members)):
        assert rows(wh.read(name)) == rows(lazy(wh.read("build_orders")))


def test_lake_versions_name_the_load_runs(spark):
    lake = scratch_dir(spark, "t-lake-versions")
    fs = pipeline.CommitLog(spark, lake).fs
    fs.mkdirs(f"{lake}/orders_raw/ingest_run=a")
    one = pipeline.lake_versions(spark, lake)
    fs.mkdirs(f"{lake}/orders_raw/ingest_run=b")
    assert set(one) == {"orders_raw"} and pipeline.lake_versions(spark, lake) != one


def test_rejects_are_written_beside_the_first_layer(spark, monkeypatch):
    """The models of the first layer do not wait for the scan of the rejects."""
    import threading
    started, order = threading.Event(), []
    rejects, base = pipeline.bronze.rejects, pipeline.build_model

    def slow(raw):
        order.append(started.wait(60))
        return rejects(raw)

    def model(wh, raw, name, *args):
        started.set()
        return base(wh, raw, name, *args)
    monkeypatch.setattr(pipeline.bronze, "rejects", slow)
    monkeypatch.setattr(pipeline, "build_model", model)
    monkeypatch.setattr(pipeline, "LAYERS", ("bronze",))
    root, raw = scratch_dir(spark, "t-pipeline-beside"), raw_tables(spark, SMALL)
    for _ in range(2):  # the second time nothing has changed
        pipeline.build(spark, raw, root, raw_versions=states(0))
    assert order == [True]
    assert spark.read.parquet(f"{root}/_rejects/bronze").count() == 0
