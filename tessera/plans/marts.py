"""Marts: revenue, item popularity, member spending, delivery times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import micros_between, month_label, month_start
from tessera.operators.ranking import rank_top_bottom

# Sums are published as DECIMAL(38,2), the widest exact type.
MONEY_SUM = "decimal(38,2)"


def mart_gross_revenue(build_orders: DataFrame) -> DataFrame:
    """SUM(total) per (storeid, campaignid); a NULL campaign is its own group."""
    return (build_orders.groupBy("storeid", "campaignid")
            .agg(F.sum("total").cast(MONEY_SUM).alias("total_revenue")))


# Popularity and spending labels, in CASE priority order.
POPULARITY_LABELS = ("Most Popular", "Second Most Popular",
                     "Least Popular", "Second Least Popular")
SPENDING_LABELS = ("Highest Spending", "Lowest Spending")


def mart_popular_items(build_orders: DataFrame, build_order_items: DataFrame) -> DataFrame:
    """Top-2 and bottom-2 items by line count per month, ties kept (RANK)."""
    o = build_orders.select("orderid", "orderdate")
    i = build_order_items.select("orderid", "itemname")
    # The month is truncated once per order and labelled once per result row.
    counts = (o.select("orderid", month_start("orderdate").alias("_month")).join(i, "orderid")
               .groupBy("_month", "itemname").agg(F.count(F.lit(1)).alias("order_count")))
    return popular_items_of(counts)


def popular_items_of(counts: DataFrame) -> DataFrame:
    """The mart from ``_month``, ``itemname``, ``order_count``."""
    ranked = rank_top_bottom(counts, ["_month"], "order_count", 2, 2,
                             "most_popular_rank", "least_popular_rank")
    most, least = F.col("most_popular_rank"), F.col("least_popular_rank")
    label = (F.when(most == 1, POPULARITY_LABELS[0])
              .when(most == 2, POPULARITY_LABELS[1])
              .when(least == 1, POPULARITY_LABELS[2])
              .when(least == 2, POPULARITY_LABELS[3]))
    return ranked.select(month_label("_month").alias("month_year"), "itemname", "order_count",
                         label.alias("popularity_label"))


def mart_spending_members(build_orders: DataFrame) -> DataFrame:
    """Highest and lowest spender (by member name) per month, ties kept."""
    monthly = (build_orders.where(F.col("membername").isNotNull())
               .groupBy(month_start("orderdate").alias("month"), "membername")
               .agg(F.sum("total").cast(MONEY_SUM).alias("total_spent")))
    return spending_members_of(monthly)


def spending_members_of(monthly: DataFrame) -> DataFrame:
    """The mart from ``month``, ``membername``, ``total_spent``."""
    ranked = rank_top_bottom(monthly, ["month"], "total_spent", 1, 1,
                             "highest_rank", "lowest_rank")
    label = (F.when(F.col("highest_rank") == 1, SPENDING_LABELS[0])
              .when(F.col("lowest_rank") == 1, SPENDING_LABELS[1]))
    return (ranked.select("month", "membername", "total_spent", label.alias("spending_label"))
                  .where(F.col("spending_label").isNotNull()))


def mart_order_processing_times(build_orders: DataFrame,
                                build_order_status: DataFrame) -> DataFrame:
    """Mean Submitted -> Delivered time per store.

    The first Submitted and first Delivered time are taken per order *before*
    the join (partial aggregation collapses hot orders map-side); orders are
    unique on orderid in gold, so the join is one-to-one and the per-store
    average is a second partial aggregation.  Orders lacking either status
    are left out.  The mean is exact: an integer microsecond sum (DECIMAL, no
    overflow) over the count.
    """
    o = build_orders.select("orderid", "storeid")
    per_store = (o.join(delivery_micros(build_order_status), "orderid")
                  .groupBy("storeid")
                  .agg(F.sum("micros").alias("_sum_us"), F.count(F.lit(1)).alias("_n")))
    return processing_times_of(per_store)


def delivery_micros(build_order_status: DataFrame) -> DataFrame:
    """Per order with both statuses: first Submitted to first Delivered."""
    s = build_order_status
    per_order = (s.where(F.col("status").isin("Submitted", "Delivered"))
                  .groupBy("orderid")
                  .agg(F.min(F.when(s.status == "Submitted", s.statustimestamp)).alias("submitted_time"),
                       F.min(F.when(s.status == "Delivered", s.statustimestamp)).alias("delivered_time"))
                  .where(F.col("submitted_time").isNotNull() & F.col("delivered_time").isNotNull()))
    return per_order.select("orderid", micros_between("submitted_time", "delivered_time").alias("micros"))


def processing_times_of(per_store: DataFrame) -> DataFrame:
    """The mart from ``storeid``, ``_sum_us``, ``_n``."""
    avg_us = F.col("_sum_us") / F.col("_n")
    return per_store.select(
        "storeid",
        F.make_dt_interval(secs=(avg_us / 1_000_000).cast("decimal(18,6)")).alias("avg_delivery_time"),
        (F.col("_sum_us").cast("double") / F.col("_n") / F.lit(1_000_000.0)).alias("avg_delivery_seconds"))
