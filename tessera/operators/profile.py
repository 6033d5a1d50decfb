"""Contract profile: does the *data* of a table conform to its contract?

One aggregation pass per table counts, for every contract column, rows,
NULLs, values longer than the declared VARCHAR length, and values that do
not parse in the declared date format or cast to the type the bronze layer
needs.  Contract columns absent from the data and data columns absent from
the contract are reported as ``missing`` / ``extra``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.contracts import Contract
from tessera.functions.dates import spark_pattern

LINEAGE = ("source_name", "insert_date")


def _bad_value(c) -> F.Column:
    col = F.col(c.name)
    if c.format and c.type == "string":
        pattern = spark_pattern(c.format)
        parsed = (F.try_to_timestamp(col, F.lit(pattern)) if "H" in pattern
                  else F.try_to_date(col, pattern))
        return col.isNotNull() & parsed.isNull()
    if c.cast_to:
        return col.isNotNull() & col.try_cast(c.cast_to).isNull()
    return F.lit(False)


def profile(df: DataFrame, contract: Contract) -> DataFrame:
    present = {c.lower() for c in df.columns}
    cols = [c for c in contract.columns if c.name in present]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        col = F.col(c.name)
        long_ = (F.length(col) > c.max_length) if (c.max_length and c.type == "string") else F.lit(False)
        aggs += [F.count(F.when(col.isNull(), 1)).alias(f"_n{i}"),
                 F.count(F.when(long_, 1)).alias(f"_l{i}"),
                 F.count(F.when(_bad_value(c), 1)).alias(f"_b{i}")]
    one = df.agg(*aggs)
    entries = [F.struct(F.lit(c.name).alias("column_name"), F.lit(c.not_null).alias("_req"),
                        F.col(f"_n{i}").alias("null_count"), F.col(f"_l{i}").alias("over_length_count"),
                        F.col(f"_b{i}").alias("bad_value_count"), F.lit("present").alias("_kind"))
               for i, c in enumerate(cols)]
    zero = F.lit(None).cast("bigint")
    entries += [F.struct(F.lit(c.name).alias("column_name"), F.lit(c.not_null).alias("_req"),
                         zero.alias("null_count"), zero.alias("over_length_count"),
                         zero.alias("bad_value_count"), F.lit("missing").alias("_kind"))
                for c in contract.columns if c.name not in present]
    entries += [F.struct(F.lit(name).alias("column_name"), F.lit(False).alias("_req"),
                         zero.alias("null_count"), zero.alias("over_length_count"),
                         zero.alias("bad_value_count"), F.lit("extra").alias("_kind"))
                for name in df.columns
                if name.lower() not in {c.name for c in contract.columns} | set(LINEAGE)]
    e = one.select("_rows", F.explode(F.array(*entries)).alias("e")).select("_rows", "e.*")
    # declared raw type vs the data's type (e.g. a DATE column landed as text)
    dtypes = {n.lower(): t for n, t in df.dtypes}
    wrong = [c.name for c in cols if dtypes[c.name] != c.type]
    status = (F.when(F.col("_kind") != "present", F.col("_kind"))
               .when(F.col("column_name").isin(wrong) if wrong else F.lit(False), "type mismatch")
               .when(F.col("_req") & (F.col("null_count") > 0), "null in required column")
               .when(F.col("over_length_count") > 0, "too long")
               .when(F.col("bad_value_count") > 0, "bad values")
               .otherwise("ok"))
    return e.select(F.lit(contract.table).alias("table_name"), "column_name",
                    F.col("_rows").alias("row_count"), "null_count", "over_length_count",
                    "bad_value_count", status.alias("status"))
