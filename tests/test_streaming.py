"""File-drop streams: each file once, by-name mapping, idempotent upsert."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.session import scratch_dir
from tessera.sources import csv_ingest as ci
from tessera.sources import exports
from tessera.streaming.file_ingest import ingest_stream, stream_run_id
from tessera.operators.dedup import keep_latest
from tessera.streaming.latest import LatestTable, status_stream
from tessera.streaming.upsert import intake, merge_batch, upsert_stream
from tests.test_ingest import write
from tests.conftest import SMALL


def test_stream_ingest_lands_each_file_once(spark):
    root = scratch_dir(spark, "t-stream")
    folder = exports.export_order_status(spark, SMALL, f"{root}/landing")
    expect = spark.read.csv(folder, header=True).count()
    for _ in range(3):
        ingest_stream(spark, folder, f"{root}/lake", "order_status_raw", f"{root}/ckpt")
    assert ci.read_raw(spark, f"{root}/lake", "order_status_raw").count() == expect


def test_stream_upsert_maps_reordered_headers_and_replays(spark):
    root = scratch_dir(spark, "t-stream-upsert")
    land = f"{root}/landing"
    exports.export_orders(spark, SMALL, f"{land}/day1")
    table = upsert_stream(spark, f"{land}/*/orders", f"{root}/orders", f"{root}/ckpt")
    got = table.read()
    finished = spark.read.parquet(f"{SMALL}/orders.parquet").where(F.col("o_orderstatus") == "F")
    # finished orders arrive with reversed columns; they must map by name
    sample = finished.select(F.col("o_orderkey").cast("string").alias("orderid"),
                             F.col("o_orderdate").cast("date").alias("orderdate"))
    assert sample.join(got, ["orderid", "orderdate"], "left_anti").count() == 0
    files = sorted(table.read().inputFiles())
    run_id = stream_run_id(spark, f"{root}/ckpt", 0)
    merge_batch(table, spark.read.csv(f"{land}/day1/orders", header=True), run_id)  # replayed batch
    assert sorted(table.read().inputFiles()) == files and table.read().count() == got.count()


def test_split_delivery_uses_one_high_water_mark(spark):
    """The same two deliveries give the same table whether each run is one
    micro-batch or one batch per file."""
    results = []
    for per_trigger in (None, 1):
        root = scratch_dir(spark, "t-stream-split")
        land = f"{root}/landing"
        exports.export_orders(spark, SMALL, f"{land}/day1", before="2000-01-01")
        upsert_stream(spark, f"{land}/*/orders", f"{root}/orders", f"{root}/ckpt", per_trigger)
        exports.export_orders(spark, SMALL, f"{land}/day2", revision=True)
        t = upsert_stream(spark, f"{land}/*/orders", f"{root}/orders", f"{root}/ckpt", per_trigger)
        results.append(sorted(map(tuple, t.read().drop("insert_date", "source_name").collect()), key=str))
    assert results[0] == results[1]


HEAD = "orderid,memberid,storeid,campaignid,orderdate,subtotal,total\n"


def test_new_checkpoint_and_batch_load_keep_earlier_rows(spark):
    root = scratch_dir(spark, "t-stream-second")
    land, lake = f"{root}/landing/orders", f"{root}/lake"
    write(f"{land}/a.csv", HEAD + "1,m,S1,c,01/01/2023,1.00,1.00\n2,m,S1,c,02/01/2023,1.00,1.00\n")
    ingest_stream(spark, land, lake, "orders_raw", f"{root}/ckpt1")
    write(f"{land}/b.csv", HEAD + "3,m,S1,c,03/01/2023,1.00,1.00\n")
    ingest_stream(spark, land, lake, "orders_raw", f"{root}/ckpt2")  # sees both files again
    ids = sorted(r["orderid"] for r in ci.read_raw(spark, lake, "orders_raw").collect())
    assert ids == ["1", "1", "2", "2", "3"]
    ci.ingest(spark, f"{root}/landing", lake, run_id="batch-1")  # one layout for batch and stream
    assert ci.read_raw(spark, lake, "orders_raw").count() == 8


def test_stream_reports_files_and_keeps_every_row(spark):
    root = scratch_dir(spark, "t-stream-report")
    land, lake = f"{root}/landing/orders", f"{root}/lake"
    write(f"{land}/my file.csv", HEAD + "1,m,S1,c,01/01/2023,1.00,1.00\n2,m,S1,c,bad,1.00,1.00\n"
                                        "3,m,\"S\n1\",c,01/01/2023,1.00,1.00\n,m,S1,c,01/01/2023,1.00,1.00\n")
    write(f"{land}/twice.csv", "orderid,orderid,storeid,campaignid,orderdate,subtotal,total\n1,1,S,c,01/01/2023,1,1\n")
    write(f"{land}/lineage.csv", HEAD.strip() + ",source_name\n1,m,S,c,01/01/2023,1,1,x\n")
    ingest_stream(spark, land, lake, "orders_raw", f"{root}/ckpt")
    report = {r["file_name"]: r["accepted"] for r in ci.read_manifest(spark, lake).collect()}
    assert report == {"my file.csv": True, "twice.csv": False, "lineage.csv": False}
    good = {r["orderid"]: r["storeid"] for r in ci.read_raw(spark, lake, "orders_raw").collect()}
    assert good == {"1": "S1", "3": "S\n1"}
    assert ci.read_quarantine(spark, lake, "orders_raw").count() == 2


def test_upsert_stream_keeps_rejected_late_and_later_deliveries(spark):
    root = scratch_dir(spark, "t-upsert-keep")
    land = f"{root}/landing/orders"
    write(f"{land}/a.csv", HEAD + "1,m,S1,c,01/01/2023,1.00,1.00\n2,m,S1,c,bad,1.00,1.00\n")
    t = upsert_stream(spark, land, f"{root}/orders", f"{root}/ckpt")
    write(f"{root}/landing2/orders/b.csv", HEAD + "3,m,S1,c,02/01/2023,1.00,1.00\n4,m,S1,c,31/12/2022,1.00,1.00\n"
                                                  "5,m,S1,c,,1.00,1.00\n")
    t = upsert_stream(spark, f"{root}/landing2/orders", f"{root}/orders", f"{root}/ckpt2")
    assert sorted(r["orderid"] for r in t.read().collect()) == ["1", "3"]
    aside = {r["orderid"]: r["reject_reason"] for r in ci.read_quarantine(spark, intake(t), "orders_raw").collect()}
    assert aside == {"2": "orderdate: not a DD/MM/YYYY value", "4": "late", "5": "undated"}
    counts = spark.read.parquet(f"{intake(t)}/_metrics").agg(F.sum("late_rows"), F.sum("undated_rows")).first()
    assert tuple(counts) == (1, 1)


def test_latest_table_equals_deduplication_in_any_order(spark):
    """Ties, older news, repeated deliveries and rows without key or date."""
    import itertools
    import random
    rng = random.Random(5)
    rows = [(rng.choice(["1", "2", "3", "4", None]), rng.choice(["a", "b"]), rng.choice([f"20{y}-01-0{d} 00:00:00" for y in (21, 22) for d in (1, 2)] + [None]),
             rng.choice(["f1", "f2", None]), rng.randint(0, 2)) for _ in range(90)]
    df = spark.createDataFrame(rows, "orderid string, status string, t string, source_name string, part int").withColumn(
        "statustimestamp", F.col("t").cast("timestamp")).drop("t")
    dated = df.where("orderid is not null and statustimestamp is not null").drop("part")
    want = sorted(keep_latest(dated, ["orderid", "status"], "statustimestamp").select(sorted(dated.columns)).collect(), key=str)
    for order in list(itertools.permutations(range(3)))[::2]:
        state = LatestTable(spark, scratch_dir(spark, "t-latest"), ["orderid", "status"], "statustimestamp")
        for k in order:
            state.fold(df.where(F.col("part") == k).drop("part"))
        version = state.table.current_version()
        assert not state.fold(df.where(F.col("part") == order[0]).drop("part")) and state.table.current_version() == version
        assert sorted(state.read().select(sorted(dated.columns)).collect(), key=str) == want


def test_status_stream_goes_on_from_its_table(spark):
    root = scratch_dir(spark, "t-latest-stream")
    head = "orderid,status,statustimestamp\n"
    write(f"{root}/a/s.csv", head + "1,placed,02/01/2023 10:00:00\n1,placed,01/01/2023 10:00:00\n2,placed,bad\n,placed,01/01/2023 10:00:00\n")
    status_stream(spark, f"{root}/a", f"{root}/status", f"{root}/ckpt")
    write(f"{root}/b/s.csv", "statustimestamp,status,orderid\n01/02/2022 10:00:00,placed,1\n01/02/2024 10:00:00,sent,1\n")
    state = status_stream(spark, f"{root}/b", f"{root}/status", f"{root}/ckpt2")  # a new checkpoint
    got = sorted((r.orderid, r.status, str(r.statustimestamp)) for r in state.read().collect())
    assert got == [("1", "placed", "2023-01-02 10:00:00"), ("1", "sent", "2024-02-01 10:00:00")]
    report = {r["file_name"] for r in ci.read_manifest(spark, f"{root}/status_intake").collect()}
    assert report == {"s.csv"}


def test_a_fold_takes_one_shuffle_for_delivery_and_state(spark, monkeypatch):
    """A delivery's rows and the state's meet once; its news are merged as they are."""
    from tessera.sources.partitioned import PartitionedTable
    merged, merge = [], PartitionedTable.merge

    def noted(self, changes, *args, **kwargs):
        merged.append(kwargs.get("unique"))
        return merge(self, changes, *args, **kwargs)
    monkeypatch.setattr(PartitionedTable, "merge", noted)
    windows, real = [], keep_latest
    from tessera.streaming import latest
    monkeypatch.setattr(latest, "keep_latest", lambda *a, **b: (windows.append(1), real(*a, **b))[1])
    state = LatestTable(spark, scratch_dir(spark, "t-fold"), ["k"], "d")
    schema = "k string, d timestamp, source_name string, v int"

    def day(n):
        return dt.datetime(2021, 1, n)

    state.fold(spark.createDataFrame([("1", day(1), "a", 1), ("1", day(2), "a", 2), ("2", day(3), "a", 1)], schema))
    state.fold(spark.createDataFrame([("1", day(1), "b", 9), ("2", day(4), "b", 2), ("2", day(3), "b", 3), ("3", day(1), "b", 1)], schema))
    assert len(windows) == 2 and merged == [True, True]
    assert sorted((r["k"], r["v"]) for r in state.read().collect()) == [("1", 2), ("2", 2), ("3", 1)]
    assert state.read().columns == ["k", "d", "source_name", "v"]
