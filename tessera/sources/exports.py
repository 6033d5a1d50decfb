"""Write test tables out as delivered CSV files (for ingestion runs).

Deliveries are written by Spark itself (one folder per table, many part
files, header in each), with the source system's dialect: comma, ``"``
quotes, doubled quotes as escape.  Data-driven irregularities, so ingestion
has real work: finished orders (status ``F``) arrive with the columns in
reverse order, and pending orders (status ``P``) carry ISO dates instead of
the contract's DD/MM/YYYY (they must be quarantined), the urgent ones among
them without an order id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.contracts import CONTRACTS


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    (df.write.mode(mode).option("header", True).option("quote", '"')
       .option("escape", '"').option("nullValue", "").option("emptyValue", '""')
       .csv(path))


def orders_delivery(spark: SparkSession, sf_dir: str, revision: bool = False,
                    before: str | None = None) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    if before is not None:
        o = o.where(o.o_orderdate < F.lit(before).cast("timestamp_ntz"))
    day = F.date_add(o.o_orderdate.cast("date"),
                     F.when(o.o_orderstatus == "P", 1).otherwise(0)) if revision \
        else o.o_orderdate.cast("date")
    date_text = F.when(o.o_orderstatus == "P", F.date_format(day, "yyyy-MM-dd")) \
                 .otherwise(F.date_format(day, "dd/MM/yyyy"))
    price = o.o_totalprice + 1 if revision else o.o_totalprice
    return o.select(
        F.when(~((o.o_orderstatus == "P") & (o.o_orderpriority == "1-URGENT")),
               o.o_orderkey.cast("string")).alias("orderid"),
        o.o_custkey.cast("string").alias("memberid"),
        F.concat(F.lit("S"), (o.o_orderkey % 20).cast("string")).alias("storeid"),
        F.when(o.o_orderpriority != "4-NOT SPECIFIED", o.o_orderpriority).alias("campaignid"),
        date_text.alias("orderdate"),
        o.o_totalprice.cast("decimal(12,2)").cast("string").alias("subtotal"),
        price.cast("decimal(12,2)").cast("string").alias("total"),
        o.o_orderstatus.alias("_status"))


def export_orders(spark: SparkSession, sf_dir: str, landing: str,
                  revision: bool = False, before: str | None = None) -> str:
    """Deliver the orders file into ``<landing>/orders/``; returns that folder.

    ``before`` limits the delivery to orders dated before that day (an
    earlier delivery of the same table).
    """
    names = CONTRACTS["orders_raw"].names
    df = orders_delivery(spark, sf_dir, revision, before)
    target = f"{landing.rstrip('/')}/orders"
    write_csv(df.where(F.col("_status") != "F").select(*names), target)
    write_csv(df.where(F.col("_status") == "F").select(*reversed(names)), target)
    return target


def export_order_status(spark: SparkSession, sf_dir: str, landing: str, part: tuple[int, int] | None = None) -> str:
    """Deliver the statuses into ``<landing>/order_status/``; ``part`` (k, n):
    the k-th of n deliveries that the rows are dealt to."""
    from tessera.sources.testdata import raw_order_status
    names = CONTRACTS["order_status_raw"].names
    target = f"{landing.rstrip('/')}/order_status"
    rows = raw_order_status(spark, sf_dir).select(*names)
    if part is not None:
        rows = rows.where(F.pmod(F.xxhash64(*names), F.lit(part[1])) == part[0])
    write_csv(rows, target)
    return target


def export_raw_tables(spark: SparkSession, sf_dir: str, landing: str) -> list[str]:
    """Deliver all six raw tables (as derived in ``testdata``) as CSV files,
    one folder per table, contract column order; DATE columns are rendered
    in their contract format.  Returns the folders written."""
    from tessera.sources.testdata import raw_tables
    folders = []
    for table, df in raw_tables(spark, sf_dir).items():
        contract = CONTRACTS[table]
        cols = [F.date_format(c.name, "dd/MM/yyyy").alias(c.name) if c.type == "date" else F.col(c.name)
                for c in contract.columns]
        folder = f"{landing.rstrip('/')}/{contract.stem}"
        write_csv(df.select(*cols), folder)
        folders.append(folder)
    return folders
