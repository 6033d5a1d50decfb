"""Keep-latest kept up to date, delivery by delivery.

A state table holds the latest row of every key, by year of its date
(:class:`~tessera.sources.partitioned.PartitionedTable`).  A delivery is
folded in by one pass over its rows and the state's: of each key the latest row
stays, by the total order of :func:`~tessera.operators.dedup.keep_latest`.
That choice is associative, commutative and idempotent, so deliveries may come
in any order, late, split over micro-batches or twice, and the table equals the
deduplication of all they held.  Only rows that win are merged: a delivery
without news writes no files, and only the years that hold a changed key are
rewritten.

The state is the table, not a state store: a stream with a new checkpoint goes
on from it, and executors hold no keys between batches.  Rows without a key or
date are left out, as the silver model does; a hot key is reduced on the map
side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.contracts import CONTRACTS
from tessera.operators.dedup import keep_latest
from tessera.plans import bronze
from tessera.sources import csv_ingest as ci
from tessera.sources.partitioned import PartitionedTable
from tessera.streaming.file_ingest import stream_run_id, stream_source, validated_batch

KEY, NEWS = "_state_key", "_state_news"
STATUS_KEYS = ("orderid", "status")


class LatestTable:
    """The latest row per ``keys`` by ``date_col`` of all deliveries folded in."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], date_col: str):
        self.keys, self.date_col = list(keys), date_col
        year = f"{date_col}_year"
        self.table = PartitionedTable(spark, root, year, lambda df: df.withColumn(year, F.year(date_col)))

    def read(self) -> DataFrame | None:
        rows = self.table.read()
        return None if rows is None else rows.drop(KEY, self.table.partition_col)

    def fold(self, delivery: DataFrame) -> bool:
        """Fold a delivery in; False if it brought nothing new."""
        dated = delivery.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (*self.keys, self.date_col)))
        base = self.table.current_version()
        if base is None:
            won = keep_latest(dated, self.keys, self.date_col)
        else:
            # one pass over both: the delivery's rows need no pass of their own.
            # The mark comes last in the order: of equal rows the state's stays
            state = self.table.read(base).drop(KEY, self.table.partition_col)
            both = state.withColumn(NEWS, F.lit(1)).unionByName(dated.withColumn(NEWS, F.lit(2)))
            won = keep_latest(both, self.keys, self.date_col).where(F.col(NEWS) == 2).drop(NEWS)
        won = won.withColumn(KEY, F.to_json(F.struct(*self.keys))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if base is not None and won.isEmpty():
                return False
            self.table.merge(won, KEY, self.date_col, base, unique=True)
            return True
        finally:
            won.unpersist()


def status_table(spark: SparkSession, root: str) -> LatestTable:
    return LatestTable(spark, root, STATUS_KEYS, "statustimestamp")


def status_stream(spark: SparkSession, folder: str, table_root: str, checkpoint: str,
                  max_files_per_trigger: int | None = 10_000) -> LatestTable:
    """Fold every not-yet-seen status file under ``folder`` in, then stop.

    Rejected rows and the report on the files are kept beside the table, under
    ``<table>_intake``.  A replayed batch folds to the same state."""
    contract = CONTRACTS["order_status_raw"]
    state, intake = status_table(spark, table_root), f"{table_root.rstrip('/')}_intake"

    def land(batch: DataFrame, batch_id: int) -> None:
        run_id = stream_run_id(spark, checkpoint, batch_id)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = validated_batch(spark, batch, contract, intake, run_id)
            if rows is not None:
                good = F.col("_reject_reason").isNull()
                ci.write_landed(rows.where(~good), contract, intake, run_id)
                state.fold(bronze.base_order_status(rows.where(good).select(*contract.names, "source_name")))
        finally:
            batch.unpersist()

    q = (stream_source(spark, folder, contract, max_files_per_trigger).writeStream
         .foreachBatch(land)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return state
