"""Edge cases of the models on tiny inline frames (invented values)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.operators import quality as dq
from tessera.operators.dedup import keep_latest
from tessera.operators.ranking import rank_top_bottom
from tessera.plans import bronze, gold, marts, silver

D = dt.date


def orders_frame(spark, rows):
    return spark.createDataFrame(rows, "orderid string, memberid string, storeid string, "
                                       "campaignid string, orderdate date, subtotal decimal(10,2), "
                                       "total decimal(10,2), source_name string")


def test_null_date_wins_desc_nulls_first(spark):
    df = spark.createDataFrame([("1", D(2024, 1, 1), "a"), ("1", None, "b")],
                               "k string, d date, source_name string")
    out = keep_latest(df, ["k"], "d").collect()
    assert len(out) == 1 and out[0]["d"] is None


def test_dedup_tie_is_deterministic(spark):
    df = spark.createDataFrame([("1", D(2024, 1, 1), "x.csv", "b"), ("1", D(2024, 1, 1), "x.csv", "a")],
                               "k string, d date, source_name string, v string")
    for _ in range(3):
        assert keep_latest(df.repartition(3), ["k"], "d").collect()[0]["v"] == "a"


def test_null_orderids_collapse_in_silver(spark):
    base = bronze.base_orders(spark.createDataFrame(
        [(None, "m", "S1", None, D(2024, 1, 1), "1.00", "1.00", "f"),
         (None, "m", "S1", None, D(2024, 1, 2), "2.00", "2.00", "f")],
        "orderid string, memberid string, storeid string, campaignid string, orderdate date, "
        "subtotal string, total string, source_name string"))
    out = silver.stg_orders(base).collect()
    assert len(out) == 1 and out[0]["orderdate"] == D(2024, 1, 2)


def test_rank_tie_for_first_leaves_no_second(spark):
    items = spark.createDataFrame([("Jan", "a", 5), ("Jan", "b", 5), ("Jan", "c", 3), ("Jan", "d", 1)],
                                  "m string, item string, n long")
    r = {row["item"]: (row["top_rank"], row["bottom_rank"])
         for row in rank_top_bottom(items, ["m"], "n", 2, 2).collect()}
    assert r["a"] == (1, None) and r["b"] == (1, None)
    assert r["c"] == (None, 2) and r["d"] == (None, 1)


def test_popular_items_labels(spark):
    o = orders_frame(spark, [("o1", "m", "S", None, D(2024, 1, 5), None, Decimal("1.00"), "f"),
                             ("o2", "m", "S", None, D(2024, 2, 5), None, Decimal("1.00"), "f")])
    items = spark.createDataFrame(
        [("o1", "x", Decimal("1"), "f"), ("o1", "x", Decimal("1"), "f"), ("o1", "y", Decimal("1"), "f"),
         ("o1", "y", Decimal("1"), "f"), ("o1", "z", Decimal("1"), "f"), ("o2", "solo", Decimal("1"), "f")],
        "orderid string, itemname string, price decimal(10,2), source_name string")
    built = o.withColumn("membername", F.lit("n"))
    got = {(r["month_year"], r["itemname"]): r["popularity_label"]
           for r in marts.mart_popular_items(built, items).collect()}
    assert got[("Jan-2024", "x")] == "Most Popular"
    assert got[("Jan-2024", "y")] == "Most Popular"
    assert got[("Jan-2024", "z")] == "Least Popular"
    assert got[("Feb-2024", "solo")] == "Most Popular"


def test_spending_ties_and_null_member(spark):
    o = orders_frame(spark, [("o1", "m", "S", None, D(2024, 1, 5), None, Decimal("10.00"), "f"),
                             ("o2", "m", "S", None, D(2024, 1, 6), None, Decimal("10.00"), "f"),
                             ("o3", "m", "S", None, D(2024, 1, 7), None, Decimal("1.00"), "f"),
                             ("o4", "m", "S", None, D(2024, 1, 8), None, Decimal("99.00"), "f")])
    names = F.when(F.col("orderid") == "o1", "ann").when(F.col("orderid") == "o2", "bob") \
             .when(F.col("orderid") == "o3", "cy")
    got = {r["membername"]: r["spending_label"]
           for r in marts.mart_spending_members(o.withColumn("membername", names)).collect()}
    assert got == {"ann": "Highest Spending", "bob": "Highest Spending", "cy": "Lowest Spending"}


def test_null_campaign_is_its_own_revenue_group(spark):
    o = orders_frame(spark, [("o1", "m", "S1", None, D(2024, 1, 1), None, Decimal("1.50"), "f"),
                             ("o2", "m", "S1", None, D(2024, 1, 1), None, Decimal("2.50"), "f"),
                             ("o3", "m", "S1", "c", D(2024, 1, 1), None, Decimal("1.00"), "f")])
    got = {r["campaignid"]: r["total_revenue"] for r in marts.mart_gross_revenue(o).collect()}
    assert got == {None: Decimal("4.00"), "c": Decimal("1.00")}


def test_processing_time_skips_orders_missing_a_status(spark):
    o = orders_frame(spark, [("o1", "m", "S1", None, D(2024, 1, 1), None, None, "f"),
                             ("o2", "m", "S1", None, D(2024, 1, 1), None, None, "f")])
    ts = dt.datetime
    st = spark.createDataFrame(
        [("o1", "Submitted", ts(2024, 1, 1, 0, 0, 0)), ("o1", "Delivered", ts(2024, 1, 1, 1, 0, 0)),
         ("o1", "Delivered", ts(2024, 1, 1, 3, 0, 0)), ("o2", "Submitted", ts(2024, 1, 1, 0, 0, 0)),
         ("o2", "delivered", ts(2024, 1, 1, 5, 0, 0))],
        "orderid string, status string, statustimestamp timestamp_ntz")
    r = marts.mart_order_processing_times(o, st).collect()
    assert len(r) == 1 and r[0]["avg_delivery_seconds"] == 3600.0
    assert r[0]["avg_delivery_time"] == dt.timedelta(hours=1)


def test_quality_positive_and_after_semantics(spark):
    df = spark.createDataFrame([(Decimal("0"), D(2024, 1, 1), D(2024, 1, 1)),
                                (Decimal("-1"), D(2024, 1, 1), D(2023, 12, 31)),
                                (None, None, D(2024, 1, 1))],
                               "price decimal(10,2), start date, finish date")
    assert [r["price"] for r in dq.non_negative(df, "price").collect()] == [Decimal("-1")]
    assert dq.after(df, "finish", "start").count() == 1
    assert dq.after(df, "finish", "'2024-01-01'").count() == 1


def test_relationships_ignores_null_child_keys(spark):
    child = spark.createDataFrame([("a",), (None,), ("z",)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert [r["k"] for r in dq.relationships(child, "k", parent, "k").collect()] == ["z"]


def test_bronze_dates_and_truncation(spark):
    raw = spark.createDataFrame([("x" * 120, "N", "Gold" * 20, "7/2/2023", None, "f"),
                                 ("1", "N", "Gold", "7/2/2023", "31/02/2023", "f"),   # no such day
                                 ("2", "N", "Gold", "2022-01-01", "07/02/2024", "g"),  # not the contract's format
                                 ("2", "N", "Gold", "07/02/2023", "07/02/2024", "f")],
                                "id string, name string, membershiptype string, joindate string, "
                                "expirationdate string, source_name string")
    got = {r["memberid"]: r for r in bronze.base_members(raw).collect()}
    r = got.pop("x" * 100)
    assert len(r["membershiptype"]) == 50
    assert r["joindate"] == D(2023, 2, 7) and r["expirationdate"] is None
    assert [r["joindate"] for r in got.values()] == [D(2023, 2, 7)]  # bad text never wins as a missing date
    bad = bronze.rejects({"members_raw": raw}).collect()
    assert {(r["column_name"], r["cell"]) for r in bad} == {("expirationdate", "31/02/2023"), ("joindate", "2022-01-01")}


def test_member_preferences_keep_orphans(spark):
    prefs = spark.createDataFrame([("1", "spicy", "f", None), ("9", "mild", "f", None)],
                                  "memberid string, preference string, source_name string, insert_date timestamp_ntz")
    members = spark.createDataFrame([("1", "Ann", "Gold", D(2023, 1, 1), D(2024, 1, 1))],
                                    "memberid string, membername string, membershiptype string, "
                                    "joindate date, expirationdate date")
    got = {r["memberid"]: r["membername"] for r in gold.build_member_preferences(prefs, members).collect()}
    assert got == {"1": "Ann", "9": None}


def test_aggregate_dedup_matches_window(spark):
    from tessera.operators.dedup import keep_latest_by_aggregate
    rows = [("1", D(2024, 1, 1), "b.csv", "x"), ("1", D(2024, 1, 1), "a.csv", "y"),
            ("1", D(2023, 1, 1), "a.csv", "z"), ("2", None, "a.csv", "p"), ("2", D(2024, 5, 1), "a.csv", "q"),
            ("3", D(2024, 1, 1), None, "r"), ("3", D(2024, 1, 1), "a.csv", None),
            ("3", D(2024, 1, 1), "a.csv", "s")]
    df = spark.createDataFrame(rows, "k string, d date, source_name string, v string")
    a = sorted(map(tuple, keep_latest(df, ["k"], "d").collect()), key=str)
    b = sorted(map(tuple, keep_latest_by_aggregate(df, ["k"], "d").collect()), key=str)
    assert a == b
    assert {r[0]: r[3] for r in a} == {"1": "y", "2": "p", "3": "r"}


def test_spread_null_keys_never_match(spark):
    from tessera.operators.joins import left_enrich
    facts = spark.createDataFrame([("o1", None), ("o2", "c1")], "orderid string, campaignid string")
    # a dimension key that equals the spread value of the NULL-key row
    dim = spark.createDataFrame([("\u0000o1", "trap"), ("c1", "ok")], "campaignid string, targetaudience string")
    for broadcast_off in (False, True):
        if broadcast_off:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = {r["orderid"]: r["targetaudience"]
               for r in left_enrich(facts, dim, "campaignid", ["targetaudience"], "orderid").collect()}
        assert got == {"o1": None, "o2": "ok"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
