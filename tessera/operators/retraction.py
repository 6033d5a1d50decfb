"""Aggregates that rows can be added to and taken from.

A state has one row per group: ``n_rows``, and for a value ``n_values`` (rows
where it is not NULL) and ``total``.  Rows carry ``_sign``: 1 adds a row, -1
takes one back.  All three columns are exact sums, so folding a table's changes
into its state gives the state of the changed table, in any order and number of
steps; a group without rows is no group.  (MIN and MAX cannot be taken back:
the marts reduce those to a value per order first.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL = "decimal(38,2)"


def signed(df: DataFrame) -> DataFrame:
    """``df`` as rows to add, unless its rows have a sign already."""
    return df if "_sign" in df.columns else df.withColumn("_sign", F.lit(1))


def state(rows: DataFrame, keys: Sequence[str], value: Column | None = None, total_type: str = TOTAL) -> DataFrame:
    """The state of signed ``rows``; one of changes may hold negative counts."""
    sums = [F.sum("_sign").cast("long").alias("n_rows")]
    if value is not None:
        sums += [F.sum(F.when(value.isNotNull(), F.col("_sign")).otherwise(0)).cast("long").alias("n_values"),
                 F.coalesce(F.sum(F.when(F.col("_sign") > 0, value).otherwise(-value)), F.lit(0)).cast(total_type).alias("total")]
    return rows.groupBy(*keys).agg(*sums)


def fold(before: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``before`` with the changes of ``delta``, a state as well."""
    sums = [c for c in before.columns if c not in keys]
    types = dict(before.dtypes)
    out = before.unionByName(delta.select(*before.columns)).groupBy(*keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in sums])
    return out.where(F.col("n_rows") != 0).select(*before.columns)


def value_of(total: str = "total") -> Column:
    """SUM of the value: NULL where all of the group's values are."""
    return F.when(F.col("n_values") > 0, F.col(total))
