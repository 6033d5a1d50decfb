"""Written intermediate tables in the shared checkpoint folder.

Writing a table cuts lineage: a lost executor re-reads files instead of
recomputing earlier stages.  Tables that a query no longer needs are dropped
as soon as possible, the rest when the driver's JVM ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.ship import ship
from tessera.session import scratch_dir
from tessera.sources.fs import HadoopFS


class Scratch:
    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = scratch_dir(spark, name)
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        HadoopFS(self.spark).delete(df._scratch_path)

    def drop_all(self) -> None:
        HadoopFS(self.spark).delete(self.root)
