"""Name the landed raw tables and the built models as SQL views.

The source system exposed every layer as database tables for ad-hoc SQL.
Here the same names are temporary views over the Parquet tables, so
``spark.sql("SELECT ... FROM mart_gross_revenue")`` works after a build.
Views read the current committed version of each table at query time of
registration; re-register after a new build.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.contracts import CONTRACTS
from tessera.sources import csv_ingest as ci


def register(spark: SparkSession, lake: str | None = None,
             warehouse: str | None = None) -> list[str]:
    names = []
    if lake:
        for table, df in ci.raw_from_lake(spark, lake, CONTRACTS).items():
            df.createOrReplaceTempView(table)
            names.append(table)
    if warehouse:
        from tessera.plans import pipeline
        wh = pipeline.Warehouse(spark, warehouse)
        for model in pipeline.SPECS:
            df = wh.read(model)
            if df is not None:
                df.createOrReplaceTempView(model)
                names.append(model)
    return names
