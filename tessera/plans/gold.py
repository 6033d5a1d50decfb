"""Gold: enrich orders with member and campaign attributes (order grain kept),
refresh the order-line and status tables, join preferences to members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import utc_now

from tessera.operators.joins import left_enrich, shuffled, star_except


def _stamp() -> F.Column:
    return utc_now().alias("insert_date")


MEMBER_ATTRIBUTES = ["membername", "membershiptype", "joindate", "expirationdate"]
CAMPAIGN_ATTRIBUTES = ["targetaudience", "campaignstartdate", "campaignenddate"]


def build_orders(stg_orders: DataFrame, stg_members: DataFrame,
                 stg_marketing: DataFrame) -> DataFrame:
    """Orders LEFT JOIN members (memberid) LEFT JOIN marketing (campaignid).

    Both dimensions are unique on their key (silver), so the grain stays one
    row per order.  Order columns except memberid/insert_date come first,
    then member and campaign attributes, as in the source model.
    """
    o_cols = [c for c in stg_orders.columns if c not in ("memberid", "insert_date")]
    with_members = left_enrich(stg_orders, shuffled(stg_members), "memberid", MEMBER_ATTRIBUTES,
                               spread_nulls_by="orderid")
    enriched = left_enrich(with_members, stg_marketing, "campaignid", CAMPAIGN_ATTRIBUTES,
                           spread_nulls_by="orderid")
    return enriched.select(*o_cols, *MEMBER_ATTRIBUTES, *CAMPAIGN_ATTRIBUTES, _stamp())


def build_order_items(stg_items: DataFrame) -> DataFrame:
    return stg_items.select(*star_except(stg_items, ["insert_date"]), _stamp())


def build_order_status(stg_status: DataFrame) -> DataFrame:
    return stg_status.select(*star_except(stg_status, ["insert_date"]), _stamp())


def build_member_preferences(stg_preferences: DataFrame, stg_members: DataFrame) -> DataFrame:
    """Preferences LEFT JOIN members.

    The source model projects only the member attributes; memberid and
    preference are kept here too, so its output is a projection of ours.
    """
    joined = left_enrich(stg_preferences, shuffled(stg_members), "memberid", MEMBER_ATTRIBUTES)
    return joined.select("memberid", "preference", *MEMBER_ATTRIBUTES, _stamp())
