"""Wire the 20 models into one lazy DAG (``ref`` edges are function calls)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from tessera.plans import bronze, gold, marts, silver


@dataclass
class Layers:
    """Lazy medallion DAG over six raw tables keyed by raw table name."""

    raw: dict[str, DataFrame]

    # bronze
    @cached_property
    def base_orders(self) -> DataFrame:
        return bronze.base_orders(self.raw["orders_raw"])

    @cached_property
    def base_orders_items(self) -> DataFrame:
        return bronze.base_orders_items(self.raw["orders_items_raw"])

    @cached_property
    def base_order_status(self) -> DataFrame:
        return bronze.base_order_status(self.raw["order_status_raw"])

    @cached_property
    def base_members(self) -> DataFrame:
        return bronze.base_members(self.raw["members_raw"])

    @cached_property
    def base_marketing(self) -> DataFrame:
        return bronze.base_marketing(self.raw["marketing_raw"])

    @cached_property
    def base_preferences(self) -> DataFrame:
        return bronze.base_preferences(self.raw["preferences_raw"])

    # silver
    @cached_property
    def stg_orders(self) -> DataFrame:
        return silver.stg_orders(self.base_orders)

    @cached_property
    def stg_members(self) -> DataFrame:
        return silver.stg_members(self.base_members)

    @cached_property
    def stg_marketing(self) -> DataFrame:
        return silver.stg_marketing(self.base_marketing)

    @cached_property
    def stg_order_status(self) -> DataFrame:
        return silver.stg_order_status(self.base_order_status)

    @cached_property
    def stg_orders_items(self) -> DataFrame:
        return silver.stg_orders_items(self.base_orders_items)

    @cached_property
    def stg_preferences(self) -> DataFrame:
        return silver.stg_preferences(self.base_preferences)

    # gold
    @cached_property
    def build_orders(self) -> DataFrame:
        return gold.build_orders(self.stg_orders, self.stg_members, self.stg_marketing)

    @cached_property
    def build_order_items(self) -> DataFrame:
        return gold.build_order_items(self.stg_orders_items)

    @cached_property
    def build_order_status(self) -> DataFrame:
        return gold.build_order_status(self.stg_order_status)

    @cached_property
    def build_member_preferences(self) -> DataFrame:
        return gold.build_member_preferences(self.stg_preferences, self.stg_members)

    # marts
    @cached_property
    def mart_gross_revenue(self) -> DataFrame:
        return marts.mart_gross_revenue(self.build_orders)

    @cached_property
    def mart_popular_items(self) -> DataFrame:
        return marts.mart_popular_items(self.build_orders, self.build_order_items)

    @cached_property
    def mart_spending_members(self) -> DataFrame:
        return marts.mart_spending_members(self.build_orders)

    @cached_property
    def mart_order_processing_times(self) -> DataFrame:
        return marts.mart_order_processing_times(self.build_orders, self.build_order_status)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)


BRONZE = ["base_orders", "base_orders_items", "base_order_status", "base_members",
          "base_marketing", "base_preferences"]
SILVER = ["stg_orders", "stg_members", "stg_marketing", "stg_order_status",
          "stg_orders_items", "stg_preferences"]
GOLD = ["build_orders", "build_order_items", "build_order_status", "build_member_preferences"]
MARTS = ["mart_gross_revenue", "mart_popular_items", "mart_spending_members",
         "mart_order_processing_times"]
MODELS = BRONZE + SILVER + GOLD + MARTS
