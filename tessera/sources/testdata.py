"""Raw tables derived from the benchmark parquet tables.

The retail pipeline expects six landed raw tables (text columns plus
``source_name`` / ``insert_date`` lineage).  These adapters derive them from
the TPC-H-like test tables with plain DataFrame expressions, so every query
reads the given tables and its work grows with them.  Edge cases that clean
synthetic data lacks (duplicates, NULL dates, blank keys, orphans, negative
prices) come from data-driven rules, never from row caps or key subsets:

* orders: one per ``o_orderkey``; 20 stores from the key; priority
  ``4-NOT SPECIFIED`` means "no campaign" (NULL campaignid).  Open orders
  (status ``O``) are re-sent in a second file dated one day later with the
  total revised up by 1.00, so silver's keep-latest dedup has work.
* order items: one per lineitem, named by its part; parts larger than size
  45 have no catalogue name (NULL itemname); returned lines (flag ``R``) are
  credit lines with a negative price.
* order status: ``Submitted`` at the order date, ``Delivered`` at every line's
  ship date (so several per order), plus web events whose type is the status;
  ``error`` events carry no timestamp.
* members: every customer outside the MACHINERY segment (their orders are
  orphans), plus an update file re-delivering BUILDING customers with a later
  join date and customers with a negative balance with a blank join date.
* marketing: one row per (priority, order status): campaigns are re-sent
  with several start dates.
* preferences: distinct (user, event type) pairs; ``error`` has no preference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed load time stamped on every fixture row (the loader's insert_date).
LOAD_TS = "2024-02-01 00:00:00"


_READS: dict[tuple[int, str, str], DataFrame] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One resolved scan per table and session (the schema is read once)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
    return _READS[key]


def _lineage(source: str) -> list:
    return [F.lit(source).alias("source_name"),
            F.lit(LOAD_TS).cast("timestamp_ntz").alias("insert_date")]


def _money_text(c) -> F.Column:
    return c.cast("decimal(12,2)").cast("string")


def _member(o: DataFrame) -> F.Column:
    """The customer; pending orders (status ``P``) name members nobody knows."""
    key = F.col("o_custkey").cast("string")
    return F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("X"), key)).otherwise(key)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")

    def sent(shift: int, source: str) -> F.Column:
        return F.struct(F.lit(shift).alias("shift"), F.lit(source).alias("source"))

    first, again = sent(0, "orders.csv"), sent(1, "orders_resend.csv")
    twice = o.select("*", F.explode(F.when(o.o_orderstatus == "O", F.array(first, again))
                                    .otherwise(F.array(first))).alias("d"))
    return twice.select(
        F.col("o_orderkey").cast("string").alias("orderid"), _member(o).alias("memberid"),
        F.concat(F.lit("S"), (F.col("o_orderkey") % 20).cast("string")).alias("storeid"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("campaignid"),
        F.date_add(F.col("o_orderdate").cast("date"), F.col("d.shift")).alias("orderdate"),
        _money_text(F.col("o_totalprice")).alias("subtotal"),
        _money_text(F.col("o_totalprice") + F.col("d.shift")).alias("total"),
        F.col("d.source").alias("source_name"), _lineage("")[1])


def raw_orders_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next delivery of the orders file: every order re-sent with its
    total revised up by 1.00; pending orders (status ``P``) moved one day
    later, so some cross into the next year and into the load window."""
    o = _table(spark, sf_dir, "orders")
    shift = F.when(o.o_orderstatus == "P", 1).otherwise(0)
    return o.select(
        o.o_orderkey.cast("string").alias("orderid"),
        _member(o).alias("memberid"),
        F.concat(F.lit("S"), (o.o_orderkey % 20).cast("string")).alias("storeid"),
        F.when(o.o_orderpriority != "4-NOT SPECIFIED", o.o_orderpriority).alias("campaignid"),
        F.date_add(o.o_orderdate.cast("date"), shift).alias("orderdate"),
        _money_text(o.o_totalprice).alias("subtotal"),
        _money_text(o.o_totalprice + 1).alias("total"),
        *_lineage("orders_revision.csv"))


def raw_orders_relocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery after the revision: urgent orders move ten years on and to
    another store with a higher total; totals of store ``S3`` are blank."""
    o = _table(spark, sf_dir, "orders")
    urgent = o.o_orderpriority == "1-URGENT"
    day = o.o_orderdate.cast("date")
    return o.select(
        o.o_orderkey.cast("string").alias("orderid"),
        _member(o).alias("memberid"),
        F.when(urgent, F.concat(F.lit("T"), (o.o_orderkey % 7).cast("string")))
         .otherwise(F.concat(F.lit("S"), (o.o_orderkey % 20).cast("string"))).alias("storeid"),
        F.when(o.o_orderpriority != "4-NOT SPECIFIED", o.o_orderpriority).alias("campaignid"),
        F.when(urgent, F.add_months(day, 120)).otherwise(day).alias("orderdate"),
        _money_text(o.o_totalprice).alias("subtotal"),
        F.when(o.o_orderkey % 20 != 3, _money_text(o.o_totalprice + 2)).alias("total"),
        *_lineage("orders_relocation.csv"))


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    p = _table(spark, sf_dir, "part")
    j = li.join(p, li.l_partkey == p.p_partkey, "left")
    price = F.when(j.l_returnflag == "R", -j.l_extendedprice).otherwise(j.l_extendedprice)
    return j.select(
        j.l_orderkey.cast("string").alias("orderid"),
        F.when(j.p_size <= 45, j.p_name).alias("itemname"),
        _money_text(price).alias("price"),
        *_lineage("orders_items.csv"))


_TS_TEXT = "dd/MM/yyyy HH:mm:ss"


def raw_order_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    li = _table(spark, sf_dir, "lineitem")
    ev = _table(spark, sf_dir, "events")
    submitted = o.select(
        o.o_orderkey.cast("string").alias("orderid"),
        F.lit("Submitted").alias("status"),
        F.date_format(o.o_orderdate, _TS_TEXT).alias("statustimestamp"),
        *_lineage("order_status.csv"))
    delivered = li.select(
        li.l_orderkey.cast("string").alias("orderid"),
        F.lit("Delivered").alias("status"),
        F.date_format(li.l_shipdate, _TS_TEXT).alias("statustimestamp"),
        *_lineage("order_status.csv"))
    events = ev.select(
        ev.user_id.cast("string").alias("orderid"),
        ev.event_type.alias("status"),
        F.when(ev.event_type != "error", F.date_format(ev.ts, _TS_TEXT)).alias("statustimestamp"),
        *_lineage("order_events.csv"))
    return submitted.unionByName(delivered).unionByName(events)


def raw_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    join = F.date_add(F.lit("2023-01-01").cast("date"), (c.c_custkey % 300).cast("int"))
    members = c.select(
        c.c_custkey.cast("string").alias("id"),
        c.c_name.alias("name"),
        c.c_mktsegment.alias("membershiptype"),
        F.date_format(join, "d/M/yyyy").alias("joindate"),
        F.date_format(F.date_add(join, 365), "dd/MM/yyyy").alias("expirationdate"),
        *_lineage("members.csv"))
    negative = c.c_acctbal < 0
    updates = c.where(negative | (c.c_mktsegment == "BUILDING")).select(
        c.c_custkey.cast("string").alias("id"),
        c.c_name.alias("name"),
        F.when(negative, F.lit("SUSPENDED")).otherwise(c.c_mktsegment).alias("membershiptype"),
        F.when(~negative, F.date_format(F.date_add(join, 30), "dd/MM/yyyy")).alias("joindate"),
        F.date_format(F.date_add(join, 395), "dd/MM/yyyy").alias("expirationdate"),
        *_lineage("members_update.csv"))
    return members.unionByName(updates)


def raw_marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    g = o.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.min("o_orderkey").alias("first_key"),
        F.min("o_orderdate").alias("first_date"),
        F.max("o_orderdate").alias("last_date"))
    audience = (F.when(g.o_orderstatus == "F", "Gold")
                .when(g.o_orderstatus == "O", "Silver")
                .otherwise("Silver,Gold"))
    return g.select(
        g.o_orderpriority.alias("campaignid"),
        audience.alias("targetaudience"),
        F.concat(F.lit("S"), (g.first_key % 20).cast("string")).alias("storeid"),
        F.date_format(g.first_date, "dd/MM/yyyy").alias("campaignstartdate"),
        F.date_format(g.last_date, "dd/MM/yyyy").alias("campaignenddate"),
        *_lineage("marketing.csv"))


def raw_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events")
    pairs = ev.select("user_id", "event_type").distinct()
    return pairs.select(
        pairs.user_id.cast("string").alias("memberid"),
        F.when(pairs.event_type != "error", pairs.event_type).alias("preference"),
        *_lineage("preferences.csv"))


RAW_BUILDERS = {
    "orders_raw": raw_orders,
    "orders_items_raw": raw_order_items,
    "order_status_raw": raw_order_status,
    "members_raw": raw_members,
    "marketing_raw": raw_marketing,
    "preferences_raw": raw_preferences,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}
