"""Daily file drops as a Structured Streaming file source.

The streaming file source remembers processed files in its checkpoint, so
each delivered file is landed exactly once across runs (the batch loader
re-reads every file on every run).  ``trigger(availableNow=True)`` drains
what is there and stops, which suits a scheduled daily job.  Each
micro-batch goes through the same validation as batch ingestion and is
written like a batch run: rows, loaded or quarantined, in the raw table's
``ingest_run`` partition, and the report on its files in ``_manifest``.

A run's id is the stream's id and the batch's number.  A replayed batch
(failure between the write and the checkpoint commit) rewrites its own
partition; a stream with a new checkpoint has another id, so it never
touches what an earlier stream or a batch load has written.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.contracts import CONTRACTS, Contract
from tessera.sources import csv_ingest as ci
from tessera.sources.fs import HadoopFS


def stream_source(spark: SparkSession, folder: str, contract: Contract,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of ``folder`` with positional columns ``c0..``; each
    micro-batch names them by the files' own headers
    (:func:`~tessera.sources.csv_ingest.map_by_header`), because the CSV
    source binds columns by position."""
    reader = (spark.readStream.schema(ci.positional_schema(contract)).format("csv")
              .options(**ci.csv_options(contract)).option("pathGlobFilter", "*.{csv,txt}"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(folder)
    return df.select("*", F.col("_metadata.file_path").alias("_file_path"),
                     F.col("_metadata.file_name").alias("source_name"))


def stream_run_id(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """The stream's id, which its checkpoint keeps, and the batch's number."""
    meta = json.loads(HadoopFS(spark).read_text(f"{checkpoint.rstrip('/')}/metadata"))
    return f"stream-{meta['id']}-{batch_id:010d}"


def validated_batch(spark: SparkSession, batch: DataFrame, contract: Contract,
                    lake: str, run_id: str) -> DataFrame | None:
    """The batch's rows, named and validated; its files go into the report.

    Files with a wrong header hold no rows that could be named: the report
    says so, as it does for batch loads.  The caller persists ``batch``: its
    file list is a job of its own, and the files are parsed once."""
    named, report = ci.map_by_header(spark, batch, contract)
    ci.write_manifest(spark, lake, run_id, report)
    return None if named is None else ci.validate(named, contract)


def ingest_stream(spark: SparkSession, folder: str, lake: str, table: str,
                  checkpoint: str, max_files_per_trigger: int | None = 10_000) -> None:
    """Land every not-yet-seen file of ``folder`` into ``<lake>/<table>``, then stop.

    ``max_files_per_trigger`` bounds one micro-batch (and the header reads it
    needs), so a backlog drains in several batches rather than one."""
    contract = CONTRACTS[table]

    def land(batch: DataFrame, batch_id: int) -> None:
        run_id = stream_run_id(spark, checkpoint, batch_id)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = validated_batch(spark, batch, contract, lake, run_id)
            if rows is not None:
                ci.write_landed(rows, contract, lake, run_id)
        finally:
            batch.unpersist()

    q = (stream_source(spark, folder, contract, max_files_per_trigger).writeStream
         .foreachBatch(land)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
