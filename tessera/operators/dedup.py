"""Keep-latest deduplication: ``ROW_NUMBER() OVER (PARTITION BY k ORDER BY d DESC) = 1``.

The source system sorts NULL first under DESC, so a NULL-dated row wins;
that is kept here with ``desc_nulls_first``.  ROW_NUMBER picks an arbitrary
row among ties; we add a total order (``source_name``, then every other
column) so reruns give the same winner.

Plan shape: the ``row_number() = 1`` filter lets Catalyst insert a partial
``WindowGroupLimit`` *before* the shuffle, so each map task forwards at most
one row per key.  A key holding a third of all rows (copies of one order)
therefore shuffles one row per map task, not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tie_break_order(df: DataFrame, keys: Sequence[str], order_col: str,
                    exclude: Sequence[str] = ("insert_date",)) -> list[Column]:
    """``order_col DESC NULLS FIRST`` then a deterministic total order."""
    rest = [c for c in df.columns
            if c not in set(keys) | {order_col} | set(exclude)]
    if "source_name" in rest:
        rest.remove("source_name")
        rest.insert(0, "source_name")
    return [F.col(order_col).desc_nulls_first()] + [F.col(c).asc_nulls_first() for c in rest]


def keep_latest(df: DataFrame, keys: Sequence[str], order_col: str,
                order: Sequence[Column] | None = None) -> DataFrame:
    """One row per ``keys``: the latest by ``order_col`` (NULL counts as latest)."""
    order = list(order) if order is not None else tie_break_order(df, keys, order_col)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_row_num", F.row_number().over(w))
              .where(F.col("_row_num") == 1)
              .drop("_row_num"))



def _descending_key(c: Column, dtype: str) -> Column:
    """A value that sorts ascending exactly as ``c`` sorts descending."""
    if dtype == "date":
        return -F.unix_date(c)
    if dtype.startswith("timestamp"):
        return -F.unix_micros(c.cast("timestamp"))
    if dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal"):
        return -c
    raise TypeError(f"cannot order {dtype} descending inside an aggregate key")


def keep_latest_by_aggregate(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """:func:`keep_latest` as ``GROUP BY keys`` + ``min_by`` (same winner).

    The ordering struct restates ``order_col DESC NULLS FIRST`` followed by
    the ascending NULLS FIRST tie-breaks of :func:`tie_break_order`.  Being a
    GROUP BY, the result is known to Catalyst to be unique on ``keys``: a
    LEFT JOIN to it whose columns a query never reads is removed from the
    plan (outer-join elimination on distinct keys).  Used for dimensions;
    facts keep the window form.
    """
    dtypes = dict(df.dtypes)
    tie_cols = [c for c in df.columns if c not in set(keys) | {order_col, "insert_date"}]
    if "source_name" in tie_cols:
        tie_cols.remove("source_name")
        tie_cols.insert(0, "source_name")
    d = F.col(order_col)
    fields = [d.isNotNull().alias("_o0"), _descending_key(d, dtypes[order_col]).alias("_o1")]
    for i, c in enumerate(tie_cols):
        fields += [F.col(c).isNotNull().alias(f"_n{i}"), F.col(c).alias(f"_v{i}")]
    payload_cols = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*payload_cols), F.struct(*fields)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload_cols]).select(*df.columns)
