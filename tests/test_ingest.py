"""Ingestion: manifest decisions, by-name mapping, quarantine, conservation."""

import os

from pyspark.sql import functions as F

from tessera.session import scratch_dir
from tessera.sources import csv_ingest as ci
from tessera.session import local_fs_path


def write(path, text):
    p = local_fs_path(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_manifest_and_by_name_mapping(spark):
    root = scratch_dir(spark, "t-ingest")
    land = f"{root}/landing"
    write(f"{land}/members.csv", "Name,Id,MembershipType,JoinDate,ExpirationDate\n"
                                 "Ann,1,Gold,7/2/2023,07/02/2024\n")
    write(f"{land}/preferences.txt", "MemberID,Preference,Extra\n1,x,y\n")
    write(f"{land}/marketing.csv", "")
    write(f"{land}/unknown.csv", "a,b\n1,2\n")
    write(f"{land}/notes.CSV", "Id\n1\n")
    entries = {e.name: e for e in ci.build_manifest(spark, land)}
    assert "notes.CSV" not in entries  # suffix match is case-sensitive
    assert entries["members.csv"].accepted
    assert not entries["preferences.txt"].accepted and "extra" in entries["preferences.txt"].reason
    assert entries["marketing.csv"].reason == "empty file"
    assert "no contract" in entries["unknown.csv"].reason
    ci.ingest(spark, land, f"{root}/lake")
    audit = {r["file_name"]: r["accepted"] for r in spark.read.parquet(f"{root}/lake/_manifest").collect()}
    assert audit == {"members.csv": True, "preferences.txt": False, "marketing.csv": False,
                     "unknown.csv": False}
    row = ci.read_raw(spark, f"{root}/lake", "members_raw").collect()[0]
    assert (row["id"], row["name"], row["joindate"]) == ("1", "Ann", "7/2/2023")
    assert row["source_name"] == "members.csv"


def test_quarantine_and_conservation(spark):
    root = scratch_dir(spark, "t-quarantine")
    land = f"{root}/landing"
    write(f"{land}/orders.csv",
          "orderid,memberid,storeid,campaignid,orderdate,subtotal,total\n"
          "1,m1,S1,,7/2/2023,1.00,1.00\n"           # good, one-digit date, blank campaign
          "2,m1,S1,c,31/02/2023,1.00,1.00\n"        # impossible date
          "3,m1,S1,c,bad,1.00,1.00\n"               # not a date
          ",m1,S1,c,01/01/2023,1.00,1.00\n"         # missing key
          "5,m1,S1,c,01/01/2023,abc,1.00\n"         # not a number
          "6,m1,S1\n"                               # ragged
          "7,m1,\"S,1\",\"say \"\"hi\"\"\",02/01/2023,1.00,1.00\n"  # quoted comma, doubled quote
          "8,m1,S1,c,,1.00,1.00\n")                # empty date: NULL, not rejected
    ci.ingest(spark, land, f"{root}/lake", run_id="r1")
    ci.ingest(spark, land, f"{root}/lake", run_id="r1")  # a retried run replaces its output
    good = {r["orderid"]: r for r in ci.read_raw(spark, f"{root}/lake", "orders_raw").collect()}
    bad = {r["orderid"]: r["reject_reason"]
           for r in ci.read_quarantine(spark, f"{root}/lake", "orders_raw").collect()}
    assert set(good) == {"1", "7", "8"} and good["8"]["orderdate"] is None
    assert str(good["1"]["orderdate"]) == "2023-02-07" and good["1"]["campaignid"] is None
    assert good["7"]["storeid"] == "S,1" and good["7"]["campaignid"] == 'say "hi"'
    assert set(bad) == {"2", "3", None, "5", "6"}
    assert bad[None].startswith("orderid") and bad["6"] == "malformed row"
    lines = {r["orderid"]: r["raw_line"] for r in ci.read_quarantine(spark, f"{root}/lake", "orders_raw").collect()}
    assert lines["6"] == "6,m1,S1" and lines["2"] is None  # whole line kept for malformed rows
    assert len(good) + len(bad) == 8
    ci.export_quarantine(spark, f"{root}/lake", "orders_raw", f"{root}/errors")
    errs = spark.read.csv(f"{root}/errors", header=True)
    assert errs.columns == ["orderid", "memberid", "storeid", "campaignid", "orderdate", "subtotal", "total"]
    assert errs.count() == 5
    years = spark.read.parquet(f"{root}/lake/orders_raw").where(F.col("ingest_status") == "loaded") \
        .select("order_year").distinct().collect()
    assert {r[0] for r in years} == {2023, None}


def test_quoted_newline(spark):
    root = scratch_dir(spark, "t-multiline")
    land = f"{root}/landing"
    write(f"{land}/marketing.csv", "campaignid,targetaudience,storeid,campaignstartdate,campaignenddate\n"
                                   "c1,\"Silver,\nGold\",S1,01/01/2023,01/02/2023\n")
    ci.ingest(spark, land, f"{root}/lake")
    rows = ci.read_raw(spark, f"{root}/lake", "marketing_raw").collect()
    assert len(rows) == 1 and rows[0]["targetaudience"] == "Silver,\nGold"


def test_bad_headers_reject_only_their_file(spark):
    root = scratch_dir(spark, "t-headers")
    land = f"{root}/landing"
    write(f"{land}/preferences/a b.csv", "preference,memberid\nx,1\n")
    write(f"{land}/preferences/twice.csv", "memberid,memberid\n1,x\n")
    write(f"{land}/preferences/lineage.csv", "memberid,preference,insert_date\n1,x,2020\n")
    ci.ingest(spark, land, f"{root}/lake", run_id="2024")
    report = {r["file_name"]: r["reason"] for r in ci.read_manifest(spark, f"{root}/lake").collect()}
    assert report["a b.csv"] == "accepted" and report["twice.csv"] == "columns repeated: ['memberid']"
    assert "insert_date" in report["lineage.csv"]
    row = ci.read_raw(spark, f"{root}/lake", "preferences_raw").collect()
    assert [(r["memberid"], r["preference"]) for r in row] == [("1", "x")]
