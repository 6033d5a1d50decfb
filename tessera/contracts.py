"""Table contracts: the declared shape of every raw table.

A contract lists the file columns in order with their raw type, the date
format for columns that carry dates, and NOT NULL constraints.  The raw
layer keeps text as text ("ingest everything, clean it later"); only
``orders.orderdate`` is a DATE already at landing.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Column:
    name: str
    type: str = "string"          # Spark SQL type name of the raw column
    max_length: int | None = 255  # VARCHAR(n) of the raw table
    format: str | None = None     # contract date format, e.g. "DD/MM/YYYY"
    not_null: bool = False
    cast_to: str | None = None    # type the bronze layer casts this text to


@dataclass(frozen=True)
class Contract:
    table: str                    # raw table name, e.g. "orders_raw"
    columns: tuple[Column, ...]
    partition_by_year_of: str | None = None
    #: Quoted cells may hold line breaks.  Spark then reads each file in one
    #: task; switch it off for a table whose cells are known to hold none.
    multi_line: bool = True
    lineage: tuple[str, ...] = ("source_name", "insert_date")
    extra: dict = field(default_factory=dict)

    @property
    def stem(self) -> str:
        """File stem routed to this table (``<stem>.csv`` -> ``<stem>_raw``)."""
        return self.table[: -len("_raw")]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


# Table, column, length and format declarations of the six raw
# table contracts, kept as declared (file column order, raw types, formats).
CONTRACTS: dict[str, Contract] = {
    "orders_raw": Contract(
        "orders_raw",
        (Column("orderid", not_null=True), Column("memberid"), Column("storeid"),
         Column("campaignid"), Column("orderdate", "date", None, "DD/MM/YYYY"),
         Column("subtotal", cast_to="decimal(10,2)"),
         Column("total", cast_to="decimal(10,2)")),
        partition_by_year_of="orderdate"),
    "orders_items_raw": Contract(
        "orders_items_raw",
        (Column("orderid", max_length=100), Column("itemname"),
         Column("price", cast_to="decimal(10,2)"))),
    "order_status_raw": Contract(
        "order_status_raw",
        (Column("orderid"), Column("status"),
         Column("statustimestamp", format="DD/MM/YYYY HH24:MI:SS"))),
    "members_raw": Contract(
        "members_raw",
        (Column("id"), Column("name"), Column("membershiptype"),
         Column("joindate", format="DD-MM-YYYY"),
         Column("expirationdate", format="DD-MM-YYYY"))),
    "marketing_raw": Contract(
        "marketing_raw",
        (Column("campaignid"), Column("targetaudience"), Column("storeid"),
         Column("campaignstartdate", format="DD/MM/YYYY"),
         Column("campaignenddate", format="DD/MM/YYYY"))),
    "preferences_raw": Contract(
        "preferences_raw", (Column("memberid"), Column("preference"))),
}
