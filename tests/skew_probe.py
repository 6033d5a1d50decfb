"""Run keep-latest on data where one key holds a third of the rows and print
the shuffle records written (from the event log).  Used by test_skew.py in a
separate process, because event logging is fixed at session start."""

import glob
import io
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators.dedup import keep_latest  # noqa: E402
from tessera.operators.ranking import rank_top_bottom  # noqa: E402
from tessera.session import local_session  # noqa: E402


def shuffle_records(log_dir: str) -> int:
    import zstandard
    total = 0
    for f in glob.glob(f"{log_dir}/*/events_*") + glob.glob(f"{log_dir}/*.zstd"):
        raw = open(f, "rb").read()
        data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read() \
            if f.endswith(".zstd") else raw
        for line in data.decode().splitlines():
            e = json.loads(line)
            if e.get("Event") == "SparkListenerTaskEnd":
                m = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                total += m.get("Shuffle Records Written", 0)
                nodes = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                MOST[0] = max(MOST[0], nodes.get("Total Records Read", 0))
    return total


MOST = [0]  # records that one task read from shuffles


def main() -> None:
    log_dir, case, limit_on = sys.argv[1], sys.argv[2], sys.argv[3] == "1"
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
             "spark.sql.adaptive.enabled": "false"}
    if not limit_on:
        extra["spark.sql.optimizer.windowGroupLimitThreshold"] = "-1"
    spark = local_session(4, 4, extra=extra)
    n = 120_000
    ids = spark.range(n, numPartitions=6)
    if case == "dedup":
        # a third of all rows are copies of one order
        df = ids.select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 500).cast("int")).alias("d"),
                        F.lit("f.csv").alias("source_name"), F.col("id").alias("v"))
        out = keep_latest(df, ["k"], "d")
        expect_rows = n - n // 3 + 1
    elif case == "tied":
        # one month holds a third of the items, and all of them tie at 1
        hot = F.col("id") % 3 == 0
        df = ids.select(F.when(hot, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("m"),
                        F.col("id").cast("string").alias("item"), F.when(hot, F.lit(1)).otherwise(F.col("id") % 997).alias("n"))
        out = rank_top_bottom(df, ["m"], "n", 2, 2).where("m = 'hot'")
        expect_rows = n // 3
    else:
        # one month holds a third of the (month, item) rows
        df = ids.select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("m"),
                        F.col("id").cast("string").alias("item"), (F.col("id") % 997).alias("n"))
        out = rank_top_bottom(df, ["m"], "n", 2, 2)
        expect_rows = None
    rows = out.count()
    spark.stop()
    print(json.dumps({"rows": rows, "expect_rows": expect_rows,
                      "shuffle_records": shuffle_records(log_dir), "most_in_a_task": MOST[0]}))


if __name__ == "__main__":
    main()
