"""Silver: deduplicate (keep latest per key) and drop rows with NULL keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import utc_now

from tessera.operators.dedup import keep_latest, keep_latest_by_aggregate


def _restamp(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns, utc_now().alias("insert_date"))


ORDER_COLUMNS = ["orderid", "memberid", "storeid", "campaignid", "orderdate",
                 "subtotal", "total", "source_name"]


def stg_orders(base: DataFrame) -> DataFrame:
    # NULL orderids are not filtered here: they collapse into one row.
    return _restamp(keep_latest(base, ["orderid"], "orderdate"), ORDER_COLUMNS)


def stg_members(base: DataFrame) -> DataFrame:
    keyed = base.where(F.col("memberid").isNotNull())
    # Dimensions dedup as a GROUP BY so Catalyst can drop unused joins to them.
    return _restamp(keep_latest_by_aggregate(keyed, ["memberid"], "joindate"),
                    ["memberid", "membername", "membershiptype", "joindate",
                     "expirationdate", "source_name"])


def stg_marketing(base: DataFrame) -> DataFrame:
    keyed = base.where(F.col("campaignid").isNotNull())
    return _restamp(keep_latest_by_aggregate(keyed, ["campaignid"], "campaignstartdate"),
                    ["campaignid", "targetaudience", "campaignstartdate",
                     "campaignenddate", "source_name"])


def stg_order_status(base: DataFrame) -> DataFrame:
    keyed = base.where(F.col("orderid").isNotNull() & F.col("statustimestamp").isNotNull())
    return _restamp(keep_latest(keyed, ["orderid", "status"], "statustimestamp"),
                    ["orderid", "status", "statustimestamp", "source_name"])


def stg_orders_items(base: DataFrame) -> DataFrame:
    # Filter only: order lines are a bag, no dedup.
    kept = base.where(F.col("orderid").isNotNull() & F.col("itemname").isNotNull())
    return _restamp(kept, ["orderid", "itemname", "price", "source_name"])


def stg_preferences(base: DataFrame) -> DataFrame:
    kept = base.where(F.col("memberid").isNotNull() & F.col("preference").isNotNull())
    return _restamp(kept, ["memberid", "preference", "source_name"])
