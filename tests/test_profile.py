"""Contract profile: counts per column, missing / extra columns, status."""

from tessera.contracts import CONTRACTS
from tessera.operators.profile import profile


def test_profile_flags(spark):
    df = spark.createDataFrame(
        [("1", "x" * 101, "9.99", "1.00", "surplus"), (None, "a", "abc", "2.00", None)],
        "orderid string, itemname string, price string, weight string, note string")
    c = CONTRACTS["orders_items_raw"]
    got = {r["column_name"]: r.asDict() for r in profile(df.drop("weight"), c).collect()}
    assert got["orderid"]["null_count"] == 1 and got["orderid"]["status"] == "ok"
    assert got["itemname"]["over_length_count"] == 0  # itemname allows 255
    assert got["price"]["bad_value_count"] == 1 and got["price"]["status"] == "bad values"
    assert got["note"]["status"] == "extra"
    members = CONTRACTS["members_raw"]
    m = spark.createDataFrame([("1", "Ann", "Gold", "7/2/2023")],
                              "id string, name string, membershiptype string, joindate string")
    got = {r["column_name"]: r["status"] for r in profile(m, members).collect()}
    # the contract declares DD-MM-YYYY for joindate while files use slashes
    assert got["joindate"] == "bad values" and got["expirationdate"] == "missing"
    orders = CONTRACTS["orders_raw"]
    o = spark.createDataFrame([(None, "m")], "orderid string, memberid string")
    got = {r["column_name"]: r["status"] for r in profile(o, orders).collect()}
    assert got["orderid"] == "null in required column"


def test_profile_type_mismatch(spark):
    orders = CONTRACTS["orders_raw"]
    o = spark.createDataFrame([("1", "01/02/2023")], "orderid string, orderdate string")
    got = {r["column_name"]: r["status"] for r in profile(o, orders).collect()}
    assert got["orderdate"] == "type mismatch" and got["orderid"] == "ok"
