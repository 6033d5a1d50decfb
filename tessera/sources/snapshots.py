"""Versioned Parquet tables: full refresh and keyed upsert sinks.

Parquet has no MERGE, and overwriting a path that the same job reads is
unsafe, so every write goes to a new version folder ``<root>/v=<n>`` and
becomes visible only once Spark's commit protocol has written its
``_SUCCESS`` marker.  Readers always take the newest committed version, so a
job that dies mid-write (lost executors, killed driver) leaves the previous
version current; a retry of the same version number simply rewrites the
uncommitted folder.  Reading the new version back also cuts the lineage of
the DataFrame that produced it.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.sources.fs import HadoopFS

_VERSION = re.compile(r"/v=(\d+)/?$")
SCHEMA_FILE = "_table_schema.json"


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str,
                 partition_by: list[str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = partition_by or []
        self.fs = HadoopFS(spark)

    def versions(self) -> list[int]:
        out = []
        for path, is_dir in self.fs.list(self.root):
            m = _VERSION.search(path)
            if is_dir and m and self.fs.exists(f"{path}/_SUCCESS"):
                out.append(int(m.group(1)))
        return sorted(out)

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def path(self, version: int) -> str:
        return f"{self.root}/v={version:010d}"

    def read(self, version: int | None = None) -> DataFrame | None:
        v = self.current_version() if version is None else version
        if v is None:
            return None
        marker = f"{self.path(v)}/{SCHEMA_FILE}"
        if self.partition_by and self.fs.exists(marker):
            # a partitioned write of no rows leaves no data file to infer from
            schema = T.StructType.fromJson(json.loads(self.fs.read_text(marker)))
            return self.spark.read.schema(schema).parquet(self.path(v))
        return self.spark.read.parquet(self.path(v))

    def write(self, df: DataFrame, version: int | None = None) -> int:
        """Write ``df`` as a new version (full refresh) and return its number."""
        cur = self.current_version()
        v = version if version is not None else (0 if cur is None else cur + 1)
        if cur is not None and v <= cur:
            return cur  # already committed (idempotent replay)
        w = df.write.mode("overwrite")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(self.path(v))
        if self.partition_by:
            self.fs.write_text(f"{self.path(v)}/{SCHEMA_FILE}", df.schema.json())
        return v

    def vacuum(self, keep: int = 2, protect: tuple[int, ...] = ()) -> list[int]:
        """Delete all but the newest ``keep`` committed versions and those of
        ``protect``."""
        versions = self.versions()
        old = [v for v in (versions[:-keep] if keep > 0 else versions) if v not in protect]
        for v in old:
            self.fs.delete(self.path(v))
        return old
