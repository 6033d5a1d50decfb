"""A hot foreign key in a shuffled dimension join is split by AQE."""

from pyspark.sql import functions as F

from tessera.operators.joins import left_enrich

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_member_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        n = 90_000
        facts = spark.range(n, numPartitions=8).select(
            F.col("id").cast("string").alias("orderid"),
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string"))
             .alias("memberid"))
        dim = (spark.range(5000).select(F.col("id").cast("string").alias("memberid"),
                                        F.lit("m").alias("membername"))
               .unionByName(spark.createDataFrame([("hot", "H")], "memberid string, membername string")))
        out = left_enrich(facts, dim, "memberid", ["membername"], spread_nulls_by="orderid")
        rows = out.groupBy("membername").count().collect()
        assert sum(r["count"] for r in rows) == n  # whole result
        assert {r["membername"]: r["count"] for r in rows}["H"] == n // 3
        joined = out.select("orderid", "membername")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
