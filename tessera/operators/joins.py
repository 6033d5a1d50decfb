"""Join helpers: star-except projections and many-to-one enrichment.

Physical strategy is left to Catalyst and AQE: a dimension whose estimated
(or, under AQE, measured) size is below ``spark.sql.autoBroadcastJoinThreshold``
is broadcast, anything larger falls back to a shuffled sort-merge join, and
AQE's skew-join handling splits an oversized partition (for instance all
rows with a NULL or hot foreign key) into several tasks.  No join here hints
a broadcast for data without a size bound.

A broadcast side passes through the driver, where a few MB of compressed keys
become a hash table of hundreds.  Sides that grow with the tables (keys of
orders, members) are marked ``shuffled``, so a build of many joins sends
the driver nothing that grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star_except(df: DataFrame, exclude: Sequence[str]) -> list[Column]:
    """Star-except projection: every column but ``exclude``, in order."""
    skip = {c.lower() for c in exclude}
    return [df[c] for c in df.columns if c.lower() not in skip]


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that never passes through the driver."""
    return df.hint("merge")


def left_enrich(facts: DataFrame, dim: DataFrame, key: str,
                dim_columns: Sequence[str], spread_nulls_by: str | None = None) -> DataFrame:
    """LEFT JOIN a many-to-one dimension on ``key``; keeps the fact grain.

    The dimension must be unique on ``key`` (silver guarantees it); NULL keys
    never match and keep NULL attributes.  In a shuffled join every NULL key
    would hash to one reducer (a fifth of all orders have no campaign), so
    with ``spread_nulls_by`` the join key of a NULL-key row is replaced by a
    value derived from that (unique) column, which spreads those rows over
    all partitions; the extra ``key IS NOT NULL`` condition keeps them from
    ever matching.  Broadcast joins are unaffected.
    """
    d = dim.select(dim[key].alias("_dim_key"), *[dim[c] for c in dim_columns])
    if spread_nulls_by is None:
        cond = facts[key] == d["_dim_key"]
    else:
        spread = F.coalesce(facts[key], F.concat(F.lit("\u0000"), facts[spread_nulls_by].cast("string")))
        cond = (spread == d["_dim_key"]) & facts[key].isNotNull()
    return facts.join(d, cond, "left").drop("_dim_key")
