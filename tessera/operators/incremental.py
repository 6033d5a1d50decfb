"""Incremental maintenance: high-water mark, late rows, keyed upsert.

* ``high_water``  - ``SELECT MAX(col) FROM target``: one scalar reaches the
  driver and becomes a literal, so the ``>=`` filter is pushed into the scan
  (and prunes year partitions when the table is partitioned by year).
* ``since``       - inclusive ``col >= high_water``; an empty target (NULL
  high water) loads everything instead of nothing.
* ``load_metrics``- how many delivered rows are loaded, late (below the
  mark, silently skipped by the source system) or undated.
* ``upsert``      - MERGE on a unique key as ``target ANTI JOIN changes
  UNION changes``.  Changes are deduplicated to one row per key (a MERGE
  with duplicate source keys is an error) and NULL keys are left out.  The
  anti join carries no hint: the adaptive plan broadcasts the change keys if
  their measured size is under the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.dedup import keep_latest


def high_water(target: DataFrame | None, column: str):
    if target is None:
        return None
    return target.agg(F.max(column).alias("hw")).first()["hw"]


def since(source: DataFrame, column: str, hw) -> DataFrame:
    if hw is None:
        return source
    return source.where(F.col(column) >= F.lit(hw))


def load_metrics(source: DataFrame, column: str, hw) -> DataFrame:
    c = F.col(column)
    loaded = c.isNotNull() if hw is None else (c >= F.lit(hw))
    late = F.lit(False) if hw is None else (c < F.lit(hw))
    return source.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count(F.when(loaded, 1)).alias("loaded_rows"),
        F.count(F.when(late, 1)).alias("late_rows"),
        F.count(F.when(c.isNull(), 1)).alias("undated_rows"),
    ).select(F.lit(hw).cast("date").alias("high_water"), "*")


def upsert(target: DataFrame, changes: DataFrame, key: str,
           order_col: str | None = None) -> DataFrame:
    changes = changes.where(F.col(key).isNotNull())
    if order_col is not None:
        changes = keep_latest(changes, [key], order_col)
    keys = changes.select(F.col(key).alias("_change_key"))
    kept = target.join(keys, target[key] == keys["_change_key"], "left_anti")
    return kept.unionByName(changes.select(*target.columns))
