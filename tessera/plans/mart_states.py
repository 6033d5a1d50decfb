"""The marts as a state that orders are added to and taken from, and a result
computed from the state (:mod:`tessera.operators.retraction`).

For each mart: ``state(orders, other)`` over orders with ``_sign`` (all orders,
or the old and new rows of the changed ones), ``result(state)``, and where ranks
are per month the column of the month, so that only the months that a change
touches are folded and ranked again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import month_label, month_start
from tessera.operators import retraction as rt
from tessera.operators.joins import shuffled
from tessera.plans import marts


@dataclass(frozen=True)
class MartState:
    keys: tuple[str, ...]
    state: Callable[..., DataFrame]
    result: Callable[[DataFrame], DataFrame]
    month: str | None = None                         # key column of the month
    label: Callable | None = None                    # the month as the mart shows it
    shown_as: str | None = None                      # its column of the mart


def revenue_state(orders: DataFrame) -> DataFrame:
    return rt.state(rt.signed(orders), ["storeid", "campaignid"], F.col("total"))


def revenue(state: DataFrame) -> DataFrame:
    return state.select("storeid", "campaignid", rt.value_of().cast(marts.MONEY_SUM).alias("total_revenue"))


def items_state(orders: DataFrame, items: DataFrame) -> DataFrame:
    o = rt.signed(orders).select("orderid", month_start("orderdate").alias("month"), "_sign")
    return rt.state(shuffled(o).join(items.select("orderid", "itemname"), "orderid"), ["month", "itemname"])


def popular_items(state: DataFrame) -> DataFrame:
    return marts.popular_items_of(state.select(F.col("month").alias("_month"), "itemname", F.col("n_rows").alias("order_count")))


def spending_state(orders: DataFrame) -> DataFrame:
    o = rt.signed(orders).where(F.col("membername").isNotNull())
    return rt.state(o.select(month_start("orderdate").alias("month"), "membername", "total", "_sign"),
                    ["month", "membername"], F.col("total"))


def spending_members(state: DataFrame) -> DataFrame:
    return marts.spending_members_of(state.select("month", "membername", rt.value_of().cast(marts.MONEY_SUM).alias("total_spent")))


def times_state(orders: DataFrame, status: DataFrame) -> DataFrame:
    o = rt.signed(orders).select("orderid", "storeid", "_sign")
    return rt.state(shuffled(o).join(marts.delivery_micros(status), "orderid"), ["storeid"], F.col("micros"), "decimal(38,0)")


def processing_times(state: DataFrame) -> DataFrame:
    return marts.processing_times_of(state.select("storeid", F.col("total").alias("_sum_us"), F.col("n_rows").alias("_n")))


STATES: dict[str, MartState] = {
    "mart_gross_revenue": MartState(("storeid", "campaignid"), revenue_state, revenue),
    "mart_popular_items": MartState(("month", "itemname"), items_state, popular_items, "month", month_label, "month_year"),
    "mart_spending_members": MartState(("month", "membername"), spending_state, spending_members, "month", lambda m: F.col(m), "month"),
    "mart_order_processing_times": MartState(("storeid",), times_state, processing_times),
}
