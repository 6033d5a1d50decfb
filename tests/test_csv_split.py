"""Quote-parity reader against the multiLine reader, at every split."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.contracts import CONTRACTS
from tessera.session import local_fs_path, scratch_dir
from tessera.sources import csv_ingest as ci
from tessera.sources import csv_split

CONTRACT = CONTRACTS["order_status_raw"]
HEAD = "orderid,status,statustimestamp"


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def delivery(seed, n, newline):
    """Cells with quotes, commas, both kinds of newline, blanks and emptiness."""
    rng = random.Random(seed)
    bits = ["a", "é", '"', '""', ",", "\n", "\r\n", " ", "x" * 30, "\n\n", "'", "\t", ""]
    out = [HEAD]
    for i in range(n):
        cells = [str(i)] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 6))) for _ in range(2)]
        out.append(",".join(quoted(c) if any(x in c for x in '",\r\n') or rng.random() < 0.2 else c for c in cells))
        if rng.random() < 0.05:
            out.append("")
    # (the last record of a CRLF file without a line end keeps its newlines as they are)
    return newline.join(out) + (newline if seed % 2 or newline == "\r\n" else "")


def write(folder, name, text):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)


def cells(df):
    return sorted(map(tuple, df.select(*CONTRACT.names, ci.CORRUPT, "source_name").collect()), key=str)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_equals_the_multiline_reader_at_every_split(spark, newline):
    landing = local_fs_path(scratch_dir(spark, "t-split"))
    for seed in (1, 2):
        write(f"{landing}/order_status", f"part {seed}+.csv", delivery(seed, 60, newline))
    write(f"{landing}/order_status", "long.csv", f'{HEAD}\n1,"{"many lines" + chr(10) * 400}",x\n2,b,c\n')
    write(f"{landing}/order_status", "ragged.csv", f"{HEAD}\n1,2\n3,4,5,6\n7,8,9\n")
    entries = ci.build_manifest(spark, landing)
    want = cells(ci.read_files(spark, CONTRACT, entries))
    assert len(want) == 125
    for size in (37, 61, 250, 1 << 20):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            df = ci.read_files(spark, CONTRACT, entries, split=True)
            assert cells(df) == want, size
            if size == 250:  # a file is read by many tasks
                tasks = csv_split.lines(spark, [e.path for e in entries]).select(F.spark_partition_id()).distinct().count()
                assert tasks > len(entries)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_irregular_quotes_are_set_aside_whole(spark):
    landing = local_fs_path(scratch_dir(spark, "t-split-bad"))
    write(f"{landing}/order_status", "a.csv", f'{HEAD}\n1,5" disk and 6" disk,x\n2,"b",c\n3,"open,\nd\n')
    lake = scratch_dir(spark, "t-split-lake")
    ci.ingest(spark, landing, lake, split=True)
    assert [r["orderid"] for r in ci.read_raw(spark, lake, "order_status_raw").collect()] == ["2"]
    bad = ci.read_quarantine(spark, lake, "order_status_raw").select("reject_reason", "raw_line").collect()
    assert sorted(map(tuple, bad)) == [("malformed row", '1,5" disk and 6" disk,x'), ("malformed row", '3,"open,\nd\n')] or \
        sorted(map(tuple, bad)) == [("malformed row", '1,5" disk and 6" disk,x'), ("malformed row", '3,"open,\nd')]


def test_files_of_a_header_alone_have_no_rows(spark):
    landing = local_fs_path(scratch_dir(spark, "t-split-empty"))
    write(f"{landing}/order_status", "a.csv", HEAD + "\n")
    write(f"{landing}/order_status", "b.csv", HEAD)
    assert ci.read_files(spark, CONTRACT, ci.build_manifest(spark, landing), split=True).count() == 0
