"""Top-k / bottom-k per group with ties (``RANK``), and their labels.

``RANK() <= k`` keeps every tie, so ranking the rows themselves would send
all items that tie at the cut (in a real month most items were sold once) to
one window task.  Ranked here is the histogram of the group instead: one row
per distinct value with its number of rows.  The k largest and the k smallest
distinct values are enough, which Catalyst limits before the shuffle
(``WindowGroupLimit``), so a window task gets at most k rows per group and
map task.  A value's rank is one more than the rows before it; values within
their bound are joined back to the rows, where skewed groups are split by the
adaptive join like any other.  For one place at either end the greatest and the
smallest value are all that is needed: one aggregate, without a window.

NULL ordering follows the source system: NULL sorts as the largest value,
i.e. first under DESC and last under ASC.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _cut(histogram: DataFrame, group_cols: Sequence[str], order, k: int, name: str) -> DataFrame:
    """(group, value, rank) of the values whose rank is at most ``k``."""
    by_value = Window.partitionBy(*group_cols).orderBy(order)
    before = by_value.rowsBetween(Window.unboundedPreceding, -1)
    return (histogram.withColumn("_place", F.row_number().over(by_value)).where(F.col("_place") <= k)
            .withColumn(name, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) + 1).cast("int"))
            .where(F.col(name) <= k).select(*group_cols, "_value", name))


def _histogram_cuts(df: DataFrame, group_cols: Sequence[str], value_col: str, k_top: int, k_bottom: int,
                    top_name: str, bottom_name: str) -> DataFrame:
    value = F.col("_value")
    histogram = (df.groupBy(*group_cols, F.col(value_col).alias("_value"))
                   .agg(F.count(F.lit(1)).alias("_rows")))
    top = _cut(histogram, group_cols, value.desc_nulls_first(), k_top, top_name)
    bottom = _cut(histogram, group_cols, value.asc_nulls_last(), k_bottom, bottom_name)
    # at most k_top + k_bottom values per group; a value in both lists is one row
    return (top.withColumn(bottom_name, F.lit(None).cast("int"))
            .unionByName(bottom.withColumn(top_name, F.lit(None).cast("int")))
            .groupBy(*group_cols, "_value").agg(F.min(top_name).alias(top_name), F.min(bottom_name).alias(bottom_name)))


def _extremes(df: DataFrame, group_cols: Sequence[str], value_col: str, top_name: str, bottom_name: str) -> DataFrame:
    """The cuts for one place at either end: greatest and smallest value, from
    a single aggregate that is reduced before its shuffle."""
    v = F.col(value_col)
    ends = df.groupBy(*group_cols).agg(F.max(v).alias("_max"), F.min(v).alias("_low"),
                                       (F.count(v) < F.count(F.lit(1))).alias("_null"))
    top, value = F.when(~F.col("_null"), F.col("_max")), F.col("_value")
    return (ends.withColumn("_top", top).withColumn("_value", F.explode(F.array_distinct(F.array("_top", "_low"))))
            .select(*group_cols, "_value", F.when(value.eqNullSafe(F.col("_top")), 1).alias(top_name),
                    F.when(value.eqNullSafe(F.col("_low")), 1).alias(bottom_name)))


def rank_top_bottom(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    k_top: int, k_bottom: int,
                    top_name: str = "top_rank",
                    bottom_name: str = "bottom_rank") -> DataFrame:
    """Rows whose descending rank <= k_top or ascending rank <= k_bottom.

    Output keeps every input column plus ``top_name`` / ``bottom_name``; a rank
    beyond its bound is NULL.
    """
    if k_top == k_bottom == 1:
        both = _extremes(df, group_cols, value_col, top_name, bottom_name)
    else:
        both = _histogram_cuts(df, group_cols, value_col, k_top, k_bottom, top_name, bottom_name)
    cuts = both.select(*[F.col(c).alias(f"_g_{c}") for c in group_cols], "_value", top_name, bottom_name)
    same = df[value_col].eqNullSafe(cuts["_value"])
    for c in group_cols:
        same = same & df[c].eqNullSafe(cuts[f"_g_{c}"])
    return df.join(cuts, same).select(*df.columns, top_name, bottom_name)
