"""Dedup and top/bottom-k against brute force on random small frames."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.dedup import keep_latest, keep_latest_by_aggregate
from tessera.operators.ranking import rank_top_bottom

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.sampled_from(["a", "b", "c", None])
dates = st.one_of(st.none(), st.dates(dt.date(2024, 1, 1), dt.date(2024, 1, 4)))
names = st.sampled_from(["x.csv", "y.csv", None])
vals = st.one_of(st.none(), st.integers(0, 3))
rows_st = st.lists(st.tuples(keys, dates, names, vals), min_size=1, max_size=25)


def brute_latest(rows):
    """Per key: date DESC NULLS FIRST, then source_name, v ASC NULLS FIRST."""
    def order(r):
        _, d, s, v = r
        return ((0,) if d is None else (1, -d.toordinal()),
                (0,) if s is None else (1, s), (0,) if v is None else (1, v))
    best = {}
    for r in rows:
        if r[0] not in best or order(r) < order(best[r[0]]):
            best[r[0]] = r
    return sorted(best.values(), key=str)


@SETTINGS
@given(rows_st)
def test_keep_latest_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, d date, source_name string, v int")
    want = brute_latest(rows)
    assert sorted(map(tuple, keep_latest(df, ["k"], "d").collect()), key=str) == want
    assert sorted(map(tuple, keep_latest_by_aggregate(df, ["k"], "d").collect()), key=str) == want


groups = st.sampled_from(["g1", "g2"])
items = st.lists(st.tuples(groups, st.one_of(st.none(), st.integers(0, 4))), min_size=1, max_size=20)


def brute_ranks(rows, k_top, k_bottom):
    """RANK with NULL sorting as the largest value (first DESC, last ASC)."""
    def big(v):
        return float("inf") if v is None else v
    out = {}
    for i, (g, v) in enumerate(rows):
        peers = [big(w) for h, w in rows if h == g]
        top = 1 + sum(1 for w in peers if w > big(v))
        bottom = 1 + sum(1 for w in peers if w < big(v))
        if top <= k_top or bottom <= k_bottom:
            out[i] = (top if top <= k_top else None, bottom if bottom <= k_bottom else None)
    return out


@SETTINGS
@given(items, st.integers(1, 2), st.integers(1, 2))
def test_rank_top_bottom_matches_brute_force(spark, rows, k_top, k_bottom):
    data = [(g, f"i{i}", v) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, item string, v int")
    got = {int(r["item"][1:]): (r["top_rank"], r["bottom_rank"])
           for r in rank_top_bottom(df, ["g"], "v", k_top, k_bottom).collect()}
    assert got == brute_ranks(rows, k_top, k_bottom)


okeys = st.sampled_from(["1", "2", "3", "4", None])
odates = st.dates(dt.date(2022, 12, 30), dt.date(2024, 1, 2))
orow = st.tuples(okeys, odates, st.integers(0, 9))
tables = st.lists(orow, min_size=0, max_size=12)


def brute_upsert(target, changes):
    """MERGE on key: changes deduplicated to the latest date (ties: smaller v),
    NULL keys left out of the change set; matched target rows replaced."""
    latest = {}
    for k, d, v in changes:
        if k is None:
            continue
        if k not in latest or (d, -v) > (latest[k][1], -latest[k][2]):
            latest[k] = (k, d, v)
    kept = [r for r in target if r[0] not in latest]
    return sorted(kept + list(latest.values()), key=str)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tables, tables)
def test_upsert_and_partition_merge_match_brute_force(spark, target, changes):
    from pyspark.sql import functions as F

    from tessera.operators.incremental import upsert
    from tessera.session import scratch_dir
    from tessera.sources.partitioned import PartitionedTable

    schema = "orderid string, orderdate date, v int"
    t = spark.createDataFrame(target, schema).withColumn("source_name", F.lit("f"))
    c = spark.createDataFrame(changes, schema).withColumn("source_name", F.lit("f"))
    want = brute_upsert(target, changes)
    got = sorted((tuple(r)[:3] for r in upsert(t, c, "orderid", "orderdate").collect()), key=str)
    assert got == want
    table = PartitionedTable(spark, scratch_dir(spark, "t-prop-merge"), "order_year",
                             lambda df: df.withColumn("order_year", F.year("orderdate")))
    table.overwrite(t)
    table.merge(c, "orderid", "orderdate")
    got = sorted((tuple(r)[:3] for r in table.read().select("orderid", "orderdate", "v").collect()), key=str)
    assert got == want


cell = st.text(alphabet=st.sampled_from(list('ab ,"\n;xé')), min_size=1, max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(cell, cell), min_size=1, max_size=6))
def test_csv_dialect_round_trip(spark, rows):
    """Cells with commas, quotes and newlines, written by Python's csv module,
    land unchanged (multi-line mode)."""
    import csv
    import os

    from tessera.session import local_fs_path, scratch_dir
    from tessera.sources import csv_ingest as ci

    root = scratch_dir(spark, "t-csv-prop")
    land = local_fs_path(f"{root}/landing")
    os.makedirs(land)
    with open(os.path.join(land, "preferences.csv"), "w", encoding="utf-8", newline="") as f:
        w = csv.writer(f)
        w.writerow(["MemberID", "Preference"])
        w.writerows(rows)
    ci.ingest(spark, f"{root}/landing", f"{root}/lake")
    got = sorted(tuple(r) for r in ci.read_raw(spark, f"{root}/lake", "preferences_raw")
                 .select("memberid", "preference").collect())
    assert got == sorted(rows)
