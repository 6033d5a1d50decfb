"""Atomic partition-level MERGE for large date-partitioned tables.

A daily delta touches few partitions, so rewriting the whole table per run
does not scale.  Files are never changed once written; a numbered commit
(:mod:`tessera.sources.commits`) says which folders make up each partition:

    <root>/_write=<n>-<id>/_kind=<live|old|new|keyless>/<partition>=<value>/part-*.parquet
    <root>/_versions/<n>.json

``merge`` on a key:

1. the delta is deduplicated per key and written (``new``), rows without a key
   apart (``keyless``);
2. the partitions that hold a changed key are found with a scan of just the
   key and partition columns;
3. those partitions are read once and written once: rows whose key does not
   change (``live``) and rows that the delta replaces (``old``).  Partitions
   where the delta only adds rows are not rewritten: the delta's folder joins
   theirs, up to ``MAX_FOLDERS``;
4. the commit makes all of it current at once.

A run that dies before step 4, at whatever point, leaves the table as it was,
plus folders that no commit names.  A reader keeps the version it opened: its
files stay until ``vacuum``.  Of two writers that start from one version the
second gets :class:`CommitConflict` and nothing of it becomes visible.

``changes`` gives a merge's old and new rows with their sign, so that tables
derived from this one can be kept up to date by adding and subtracting.

Rows without a key cannot be merged; they are kept beside the table
(``null_keys``) by the same commit, never dropped and never twice.
"""

from __future__ import annotations

import json
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.dedup import keep_latest
from tessera.operators.joins import shuffled
from tessera.sources.commits import CommitConflict, CommitLog
from tessera.sources.fs import HadoopFS

DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: A partition made of more folders is rewritten by the next merge into it.
MAX_FOLDERS = 8
WRITE, KIND = "_write", "_kind"
_WRITE_NUMBER = re.compile(rf"{WRITE}=(\d+)-")


class PartitionedTable:
    def __init__(self, spark: SparkSession, root: str, partition_col: str, derive):
        """``derive(df)`` adds ``partition_col`` to a frame of table rows."""
        self.spark, self.root = spark, root.rstrip("/")
        self.partition_col, self.derive = partition_col, derive
        self.fs = HadoopFS(spark)
        self.log = CommitLog(spark, self.root)

    # ------------------------------------------------------------- reading

    def versions(self) -> list[int]:
        return self.log.versions()

    def current_version(self) -> int | None:
        return self.log.latest()

    def exists(self) -> bool:
        return self.current_version() is not None

    def _frame(self, schema: T.StructType, folders: list[str]) -> DataFrame:
        """Rows of some folders, with ``_write`` and ``_kind``."""
        full = T.StructType([*schema.fields, T.StructField(WRITE, T.StringType()), T.StructField(KIND, T.StringType())])
        if not folders:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", self.root).parquet(*[f"{self.root}/{f}" for f in folders])

    def _read(self, entry: dict) -> DataFrame:
        schema = _schema(entry)
        return self._frame(schema, sorted(f for fs in entry["partitions"].values() for f in fs)).select(schema.names)

    def read(self, version: int | None = None) -> DataFrame | None:
        version = self.current_version() if version is None else version
        return None if version is None else self._read(self.log.read(version))

    def partition_values(self, version: int) -> list:
        """The partitions that hold rows, as the commit names them."""
        entry = self.log.read(version)
        return [_value(f, _schema(entry)[self.partition_col].dataType) for f in entry["partitions"]]

    def changes(self, since: int, version: int | None = None) -> DataFrame | None:
        """Rows that ``version`` has and ``since`` lacks (``_sign`` 1) and the
        other way round (-1); a row changed twice comes with each change.
        None if the versions are not connected by merges that are still kept."""
        version = self.current_version() if version is None else version
        kept, folders = set(self.versions()), []
        if since not in kept or version not in kept:
            return None
        schema = _schema(self.log.read(version))
        while version != since:
            entry = self.log.read(version) if version in kept else {}
            if entry.get("changes") is None or _schema(entry) != schema:
                return None
            folders += entry["changes"]
            version = entry["base"]
        sign = F.when(F.col(KIND) == "old", -1).otherwise(1)
        return self._frame(schema, folders).select(*schema.names, sign.alias("_sign"))

    # ------------------------------------------------------------- writing

    def _folder(self, value) -> str:
        return f"{self.partition_col}={DEFAULT_PARTITION if value is None else value}"

    def _in(self, values: list) -> F.Column:
        col = F.col(self.partition_col)
        cond = col.isin([v for v in values if v is not None])
        return (cond | col.isNull()) if None in values else cond

    def _write(self, rows: DataFrame, head: int | None) -> dict[str, dict[str, list[str]]]:
        """Write rows with ``_kind``; the new folders by kind and partition."""
        name = f"{WRITE}={0 if head is None else head + 1:010d}-{uuid.uuid4().hex[:12]}"
        (rows.hint("rebalance", F.col(KIND), F.col(self.partition_col))
         .write.partitionBy(KIND, self.partition_col).parquet(f"{self.root}/{name}"))
        out: dict[str, dict[str, list[str]]] = {}
        for kind in self._children(name, KIND):
            for part in self._children(f"{name}/{kind}", self.partition_col):
                out.setdefault(kind.split("=", 1)[1], {})[part] = [f"{name}/{kind}/{part}"]
        return out

    def _children(self, folder: str, column: str) -> list[str]:
        names = (p.rstrip("/").rsplit("/", 1)[-1] for p, is_dir in self.fs.list(f"{self.root}/{folder}".rstrip("/")) if is_dir)
        return [n for n in names if n.startswith(column + "=")]

    def _commit(self, head: int | None, schema: T.StructType, partitions: dict[str, list[str]], base: int | None,
                changes: list[str] | None, keyless: list[str]) -> int:
        return self.log.commit(head, {"schema": schema.json(), "partitions": partitions, "base": base, "changes": changes,
                                      "keyless": keyless})

    def overwrite(self, df: DataFrame) -> int:
        """Replace all rows; returns the version."""
        head = self.current_version()
        out = self.derive(df)
        new = self._write(out.withColumn(KIND, F.lit("live")), head)
        return self._commit(head, out.schema, new.get("live", {}), None, None, [])

    def replace(self, df: DataFrame, values: list, base: int | None = None) -> int:
        """Replace the partitions of ``values`` by ``df``, which has rows of
        those partitions only."""
        head = self.current_version()
        base = head if base is None else base
        entry = self.log.read(base)
        schema = _schema(entry)
        gone = {self._folder(v) for v in values}
        new = self._write(self.derive(df).select(*schema.names, F.lit("live").alias(KIND)), head).get("live", {})
        if not set(new) <= gone:
            raise ValueError(f"rows of other partitions: {sorted(set(new) - gone)}")
        left = {p: f for p, f in entry["partitions"].items() if p not in gone}
        return self._commit(head, schema, left | new, base, None, entry["keyless"])

    def null_keys(self) -> DataFrame | None:
        """Rows without a key that merges have set aside."""
        head = self.current_version()
        entry = {} if head is None else self.log.read(head)
        if not entry.get("keyless"):
            return None
        schema = _schema(entry)
        return self._frame(schema, entry["keyless"]).select([c for c in schema.names if c != self.partition_col])

    def merge(self, changes: DataFrame, key: str, order_col: str, base: int | None = None, unique: bool = False) -> list:
        """Upsert ``changes`` on ``key`` into version ``base`` (the current one
        if not given); returns the values of the partitions that changed.
        ``unique``: ``changes`` has one row per key already."""
        head = self.current_version()
        base = head if base is None else base
        entry = None if base is None else self.log.read(base)
        keyed = changes.where(F.col(key).isNotNull())
        if not unique:
            keyed = keep_latest(keyed, [key], order_col)
        lost = changes.where(F.col(key).isNull())
        delta = self.derive(keyed.withColumn(KIND, F.lit("live" if entry is None else "new"))
                            .unionByName(lost.withColumn(KIND, F.lit("keyless"))))
        names = [c for c in delta.columns if c != KIND] if entry is None else _schema(entry).names
        delta = delta.select(*names, KIND)
        written = self._write(delta, head)
        keyless = [f for fs in written.get("keyless", {}).values() for f in fs]
        if entry is None:
            self._commit(head, T.StructType([delta.schema[n] for n in names]), written.get("live", {}), None, None, keyless)
            return []
        schema, p, new = _schema(entry), self.partition_col, written.get("new", {})
        keys = self._frame(schema, [f for fs in new.values() for f in fs]).select(F.col(key).alias("_changed_key"))
        target = self._read(entry)
        holders = [r[0] for r in target.select(key, p).join(shuffled(keys), F.col(key) == keys["_changed_key"], "left_semi")
                   .select(p).distinct().collect()]
        values = {self._folder(v): v for v in holders} | {f: _value(f, schema[p].dataType) for f in new}
        parts = dict(entry["partitions"])
        crowded = [values[f] for f in new if len(parts.get(f, ())) >= MAX_FOLDERS]
        rewritten = {self._folder(v): v for v in holders + crowded}
        out: dict = {}
        if rewritten:
            marked = keys.select("_changed_key", F.lit(True).alias("_changed"))
            rows = target.where(self._in(list(rewritten.values()))).join(shuffled(marked), F.col(key) == marked["_changed_key"], "left")
            kind = F.when(F.col("_changed"), "old").otherwise("live")
            out = self._write(rows.select(*schema.names, kind.alias(KIND)), head)
            parts = {f: fs for f, fs in parts.items() if f not in rewritten} | out.get("live", {})
        for folder, paths in new.items():
            parts[folder] = parts.get(folder, []) + paths
        changed = [f for kind in (out.get("old", {}), new) for fs in kind.values() for f in fs]
        self._commit(head, schema, parts, base, changed, entry["keyless"] + keyless)
        return sorted(values.values(), key=lambda v: (v is None, v))

    def vacuum(self, keep: int = 2, protect: tuple[int, ...] = ()) -> list[int]:
        """Drop all but the newest ``keep`` versions and those of ``protect``,
        and the folders that only they name.  Folders that no commit names go
        too, but for those of a writer that can still make the next commit."""
        versions = self.versions()
        stay = set(versions[-keep:] if keep > 0 else []) | {v for v in protect if v in versions}
        old = [v for v in versions if v not in stay]
        if not stay:
            return []
        named = set()
        for v in stay:
            entry = self.log.read(v)
            named |= {f for fs in entry["partitions"].values() for f in fs} | {*(entry["changes"] or ()), *entry["keyless"]}
        for v in old:
            self.log.drop(v)
        for write in self._children("", WRITE):
            if int(_WRITE_NUMBER.match(write).group(1)) > versions[-1]:
                continue
            inner = [f"{write}/{k}/{p}" for k in self._children(write, KIND) for p in self._children(f"{write}/{k}", self.partition_col)]
            if not named & set(inner):
                self.fs.delete(f"{self.root}/{write}")
            else:
                for folder in set(inner) - named:
                    self.fs.delete(f"{self.root}/{folder}")
        return old


def _value(folder: str, dtype: T.DataType):
    text = folder.split("=", 1)[1]
    if text == DEFAULT_PARTITION:
        return None
    return int(text) if isinstance(dtype, T.IntegralType) else unquote(text)


def _schema(entry: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry["schema"]))


__all__ = ["PartitionedTable", "CommitConflict"]
