"""Bronze: type the raw text (cast projection, rename, date parsing).

Every model stamps ``insert_date`` with the run's ``current_timestamp()``
(constant within a query).  Bronze models are narrow projections: no
shuffle, fused into the scan's whole-stage-codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import parse_date, parse_timestamp, to_decimal, utc_now, varchar


# Text columns that bronze parses: raw table -> column -> parser and format.  Text
# that does not parse stops the source system's build; here such rows are set
# aside (``rejects``) and never reach the typed model, where their NULL would
# pass for a missing date and win a keep-latest dedup.
PARSED = {
    "order_status_raw": {"statustimestamp": (parse_timestamp, "DD/MM/YYYY HH24:MI:SS")},
    "members_raw": {c: (parse_date, "DD/MM/YYYY") for c in ("joindate", "expirationdate")},
    "marketing_raw": {c: (parse_date, "DD/MM/YYYY") for c in ("campaignstartdate", "campaignenddate")},
}


def unparsed(table: str, column: str) -> F.Column:
    """Text is there, but it is not a value of the column's type."""
    parse, contract_format = PARSED[table][column]
    return F.col(column).isNotNull() & parse(column, contract_format).isNull()


def parses(table: str) -> F.Column:
    out = F.lit(True)
    for column in PARSED[table]:
        out = out & ~unparsed(table, column)
    return out


def rejects(raw: dict[str, DataFrame]) -> DataFrame:
    """One row per cell that does not parse: table, column, cell, file."""
    out = None
    for table, columns in PARSED.items():
        if table not in raw:
            continue
        cells = F.array(*[F.when(unparsed(table, c), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("cell")))
                          for c in columns])
        part = (raw[table].select(F.lit(table).alias("table_name"), F.explode(cells).alias("x"), "source_name")
                .where("x IS NOT NULL").select("table_name", "x.column_name", "x.cell", "source_name"))
        out = part if out is None else out.unionByName(part)
    return out


def _stamp() -> F.Column:
    return utc_now().alias("insert_date")


def base_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        varchar("orderid", 100).alias("orderid"),
        varchar("memberid", 100).alias("memberid"),
        varchar("storeid", 100).alias("storeid"),
        varchar("campaignid", 100).alias("campaignid"),
        F.col("orderdate").cast("date").alias("orderdate"),
        to_decimal("subtotal").alias("subtotal"),
        to_decimal("total").alias("total"),
        "source_name", _stamp())


def base_orders_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        varchar("orderid", 100).alias("orderid"),
        F.col("itemname").cast("string").alias("itemname"),
        to_decimal("price").alias("price"),
        "source_name", _stamp())


def base_order_status(raw: DataFrame) -> DataFrame:
    # a cell that is there and parses: its value is not NULL.  A filter is not
    # pushed below explode, where it would parse every cell a second time.
    at = F.explode(F.array(parse_timestamp("statustimestamp", "DD/MM/YYYY HH24:MI:SS")))
    return raw.withColumn("_parsed", at).where(F.col("_parsed").isNotNull()).select(
        varchar("orderid", 100).alias("orderid"),
        varchar("status", 50).alias("status"),
        F.col("_parsed").alias("statustimestamp"),
        "source_name", _stamp())


def base_members(raw: DataFrame) -> DataFrame:
    return raw.where(parses("members_raw")).select(
        varchar("id", 100).alias("memberid"),
        F.col("name").cast("string").alias("membername"),
        varchar("membershiptype", 50).alias("membershiptype"),
        parse_date("joindate", "DD/MM/YYYY").alias("joindate"),
        parse_date("expirationdate", "DD/MM/YYYY").alias("expirationdate"),
        "source_name", _stamp())


def base_marketing(raw: DataFrame) -> DataFrame:
    return raw.where(parses("marketing_raw")).select(
        varchar("campaignid", 100).alias("campaignid"),
        F.col("targetaudience").cast("string").alias("targetaudience"),
        parse_date("campaignstartdate", "DD/MM/YYYY").alias("campaignstartdate"),
        parse_date("campaignenddate", "DD/MM/YYYY").alias("campaignenddate"),
        "source_name", _stamp())


def base_preferences(raw: DataFrame) -> DataFrame:
    return raw.select(
        varchar("memberid", 100).alias("memberid"),
        F.col("preference").cast("string").alias("preference"),
        "source_name", _stamp())
