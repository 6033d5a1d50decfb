"""Keyed upsert driven by a file stream (``foreachBatch``).

Each micro-batch is validated like batch ingestion (columns named by each
file's header), typed by the bronze model, cut at the table's high-water
mark and merged on the key into a year-partitioned table, rewriting only
the affected years (:class:`~tessera.sources.partitioned.PartitionedTable`).

Nothing is lost on the way.  Beside the table, under ``<table>_intake``:
rejected rows with their cells and reason, and rows below the mark (reason
``late`` or ``undated``), in ``orders_raw``; the report on every file in ``_manifest``; the
counts of each batch in ``_metrics``.

A marker per stream id and batch number makes a replayed batch (failure
between the merge and the checkpoint commit) a no-op; a stream with a new
checkpoint has another id.  A replay of a batch whose merge did not finish
merges again, which an upsert of the same changes makes harmless.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.contracts import CONTRACTS
from tessera.operators import incremental as inc
from tessera.plans import bronze
from tessera.sources import csv_ingest as ci
from tessera.sources.partitioned import PartitionedTable
from tessera.streaming.file_ingest import stream_run_id, stream_source, validated_batch

YEAR = "order_year"


def orders_table(spark: SparkSession, root: str) -> PartitionedTable:
    return PartitionedTable(spark, root, YEAR, lambda df: df.withColumn(YEAR, F.year("orderdate")))


def intake(table: PartitionedTable) -> str:
    """Where what a stream did not merge is kept."""
    return f"{table.root}_intake"


def _marker(table: PartitionedTable, run_id: str) -> str:
    return f"{table.root}/_batches/{run_id}"


_UNSET = object()


def merge_batch(table: PartitionedTable, batch: DataFrame, run_id: str,
                key: str = "orderid", date_col: str = "orderdate", hw=_UNSET) -> None:
    """Merge one micro-batch.  ``hw`` is the high-water mark of the run the
    batch belongs to; when not given it is read from the table."""
    if table.fs.exists(_marker(table, run_id)):
        return
    contract = CONTRACTS["orders_raw"]
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = validated_batch(table.spark, batch, contract, intake(table), run_id)
        if rows is not None:
            if hw is _UNSET:
                hw = inc.high_water(table.read(), date_col)
            good = F.col("_reject_reason").isNull()
            below = F.lit(False) if hw is None else F.coalesce(F.col(date_col) < F.lit(hw), F.lit(True))
            late = rows.where(good & below).withColumn(
                "_reject_reason", F.when(F.col(date_col).isNull(), "undated").otherwise("late"))
            original = F.struct(*[F.col(n).cast("string").alias(n) for n in contract.names])
            late = late.withColumn("_original", original.cast(rows.schema["_original"].dataType))
            ci.write_landed(rows.where(~good).unionByName(late), contract, intake(table), run_id)
            changes = bronze.base_orders(rows.where(good).select(*contract.names, "source_name"))
            (inc.load_metrics(changes, date_col, hw).select(F.lit(run_id).alias("ingest_run"), "*").coalesce(1)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("ingest_run").parquet(f"{intake(table)}/_metrics"))
            table.merge(inc.since(changes, date_col, hw), key, date_col)
    finally:
        batch.unpersist()
    table.fs.touch(_marker(table, run_id))


def upsert_stream(spark: SparkSession, folder: str, table_root: str, checkpoint: str,
                  max_files_per_trigger: int | None = 10_000) -> PartitionedTable:
    """Merge every not-yet-seen orders file under ``folder``, then stop.

    The high-water mark is taken once, when the run starts, as the source
    system's incremental run does: a delivery split over several
    micro-batches is cut at the same mark in each of them."""
    table = orders_table(spark, table_root)
    contract = CONTRACTS["orders_raw"]
    hw = inc.high_water(table.read(), "orderdate")
    q = (stream_source(spark, folder, contract, max_files_per_trigger).writeStream
         .foreachBatch(lambda df, bid: merge_batch(table, df, stream_run_id(spark, checkpoint, bid), hw=hw))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table
