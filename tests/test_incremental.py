"""High-water mark, upsert, snapshot versions, incremental = full refresh."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.operators import incremental as inc
from tessera.operators.dedup import keep_latest
from tessera.session import scratch_dir
from tessera.sources.snapshots import SnapshotTable

D = dt.date
SCHEMA = "orderid string, orderdate date, total decimal(10,2), source_name string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_empty_target_loads_everything(spark):
    src = frame(spark, [("1", D(2020, 1, 1), Decimal("1"), "a")])
    empty = src.limit(0)
    assert inc.high_water(empty, "orderdate") is None
    assert inc.since(src, "orderdate", None).count() == 1


def test_late_rows_dropped_and_counted(spark):
    src = frame(spark, [("1", D(2020, 1, 1), None, "a"), ("2", D(2020, 1, 5), None, "a"),
                        ("3", D(2020, 1, 4), None, "a"), ("4", None, None, "a")])
    m = inc.load_metrics(src, "orderdate", D(2020, 1, 4)).collect()[0]
    assert (m["source_rows"], m["loaded_rows"], m["late_rows"], m["undated_rows"]) == (4, 2, 1, 1)
    assert sorted(r[0] for r in inc.since(src, "orderdate", D(2020, 1, 4)).collect()) == ["2", "3"]


def test_upsert_moves_and_dedups(spark):
    target = frame(spark, [("1", D(2023, 12, 31), Decimal("1"), "t"), ("2", D(2023, 6, 1), Decimal("2"), "t"),
                           (None, D(2023, 1, 1), Decimal("9"), "t")])
    changes = frame(spark, [("1", D(2024, 1, 2), Decimal("5"), "c"), ("1", D(2024, 1, 1), Decimal("4"), "c"),
                            ("3", D(2024, 1, 1), Decimal("3"), "c"), (None, D(2024, 1, 1), Decimal("0"), "c")])
    out = {r["orderid"]: r for r in inc.upsert(target, changes, "orderid", "orderdate").collect()}
    assert set(out) == {"1", "2", "3", None}
    assert out["1"]["orderdate"] == D(2024, 1, 2) and out["1"]["total"] == Decimal("5")
    assert out[None]["total"] == Decimal("9")  # NULL keys never merge


def test_incremental_equals_full_refresh(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("orderid"),
        F.col("o_orderdate").cast("date").alias("orderdate"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total"),
        F.lit("orders.csv").alias("source_name"))
    cuts = [D(1996, 1, 1), D(1998, 1, 1), D(2000, 1, 1), D(2100, 1, 1)]
    table = SnapshotTable(spark, scratch_dir(spark, "t-inc"), partition_by=None)
    lo = None
    for v, hi in enumerate(cuts):
        delivery = o.where((F.col("orderdate") < F.lit(hi)) &
                           (F.lit(True) if lo is None else F.col("orderdate") >= F.lit(lo)))
        target = table.read()
        new = inc.since(delivery, "orderdate", inc.high_water(target, "orderdate"))
        merged = keep_latest(new, ["orderid"], "orderdate") if target is None \
            else inc.upsert(target, new, "orderid", "orderdate")
        table.write(merged, version=v)
        lo = hi
    full = keep_latest(o, ["orderid"], "orderdate")
    assert table.versions() == [0, 1, 2, 3]
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, full.collect()))


def test_snapshot_replay_is_idempotent(spark):
    table = SnapshotTable(spark, scratch_dir(spark, "t-snap"))
    df = frame(spark, [("1", D(2020, 1, 1), Decimal("1"), "a")])
    assert table.write(df, version=0) == 0
    assert table.write(df.union(df), version=0) == 0  # replay of a committed version
    assert table.read().count() == 1
    table.write(df, version=1)
    table.write(df, version=2)
    assert table.vacuum(keep=2) == [0] and table.versions() == [1, 2]


def test_uncommitted_version_is_invisible_and_rewritten(spark):
    import os
    from tessera.session import local_fs_path
    table = SnapshotTable(spark, scratch_dir(spark, "t-crash"))
    df = frame(spark, [("1", D(2020, 1, 1), Decimal("1"), "a")])
    table.write(df, version=0)
    # a job that died mid-write leaves files but no _SUCCESS marker
    broken = local_fs_path(table.path(1))
    os.makedirs(broken)
    open(os.path.join(broken, "part-00000-partial.parquet"), "wb").write(b"not parquet")
    assert table.versions() == [0] and table.read().count() == 1
    assert table.write(df.union(df), version=1) == 1  # the retry replaces the partial folder
    assert table.versions() == [0, 1] and table.read().count() == 2


def test_empty_partitioned_snapshot_keeps_its_schema(spark):
    table = SnapshotTable(spark, scratch_dir(spark, "t-empty"), partition_by=["source_name"])
    table.write(spark.createDataFrame([], SCHEMA))
    got = table.read()
    assert got.count() == 0 and set(got.columns) == {"orderid", "orderdate", "total", "source_name"}
