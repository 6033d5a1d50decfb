"""Partition-level merge: equals a full upsert, commits once, keeps readers
and the loser of a race from seeing anything half done."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.operators import incremental as inc
from tessera.session import scratch_dir
from tessera.sources import partitioned
from tessera.sources.commits import CommitLog
from tessera.sources.partitioned import CommitConflict, PartitionedTable

D = dt.date
SCHEMA = "orderid string, orderdate date, total decimal(10,2)"


def derive(df):
    return df.withColumn("order_year", F.year("orderdate"))


def table(spark, name):
    return PartitionedTable(spark, scratch_dir(spark, name), "order_year", derive)


def frame(spark, *orders):
    return spark.createDataFrame([(i, None if y is None else D(y, 6, 1), Decimal(t)) for i, y, t in orders], SCHEMA)


def rows(t, version=None):
    return sorted((r["orderid"], r["order_year"], int(r["total"])) for r in t.read(version).collect())


def files(df, value):
    return sorted(df.where(F.col("order_year") == value).select(F.input_file_name()).distinct().collect())


def test_merge_moves_rows_and_empties_partitions(spark):
    t = table(spark, "t-part")
    base = spark.createDataFrame([("1", D(2022, 5, 1), Decimal("1")), ("2", D(2023, 5, 1), Decimal("2")),
                                  ("3", D(2024, 5, 1), Decimal("3")), ("4", None, Decimal("4"))], SCHEMA)
    t.overwrite(base)
    changes = spark.createDataFrame([("1", D(2024, 6, 1), Decimal("10")), ("5", D(2024, 6, 2), Decimal("5")),
                                     ("1", D(2024, 1, 1), Decimal("9")), (None, D(2024, 1, 1), Decimal("0"))],
                                    SCHEMA)
    before = {y: files(t.read(), y) for y in (2023, 2024)}
    affected = t.merge(changes, "orderid", "orderdate")
    assert affected == [2022, 2024]
    assert files(t.read(), 2023) == before[2023]  # untouched
    assert set(before[2024]) < set(files(t.read(), 2024))  # the delta only adds rows there: nothing is rewritten
    got = sorted(map(tuple, t.read().drop("order_year").collect()), key=str)
    expect = sorted(map(tuple, inc.upsert(base, changes, "orderid", "orderdate").collect()), key=str)
    assert got == expect
    assert files(t.read(), 2022) == []  # emptied by the move
    assert [r["orderid"] for r in t.null_keys().collect()] == [None]  # set aside, not dropped


def test_partition_without_date_is_merged(spark):
    t = table(spark, "t-null-part")
    t.overwrite(frame(spark, ("1", None, 1), ("2", 2023, 2)))
    t.merge(frame(spark, ("1", 2023, 5), ("2", None, 6)), "orderid", "orderdate")
    assert Counter(map(str, rows(t))) == Counter(map(str, [("1", 2023, 5), ("2", None, 6)]))


STEPS = ("delta", "rewrite", "commit")


def die_at(monkeypatch, step):
    """The driver is lost after ``step`` has begun and done half of its work."""
    real_write, real_commit = PartitionedTable._write, CommitLog.commit
    calls = []

    def write(self, df, head):
        calls.append(1)
        out = real_write(self, df, head)
        if (step, len(calls)) in (("delta", 1), ("rewrite", 2)):
            raise KeyboardInterrupt(step)
        return out

    def commit(self, after, entry):
        if step == "commit":
            self.fs.write_text(f"{self.folder}/.half.part", "{")
            raise KeyboardInterrupt(step)
        return real_commit(self, after, entry)

    monkeypatch.setattr(PartitionedTable, "_write", write)
    monkeypatch.setattr(CommitLog, "commit", commit)


@pytest.mark.parametrize("step", STEPS)
def test_a_kill_at_any_step_leaves_the_former_version(spark, monkeypatch, step):
    t = table(spark, f"t-kill-{step}")
    t.overwrite(frame(spark, ("1", 2022, 1), ("2", 2023, 2)))
    before = rows(t)
    delta = frame(spark, ("1", 2024, 10), ("3", 2023, 3), (None, 2023, 0))
    with monkeypatch.context() as m:
        die_at(m, step)
        with pytest.raises(KeyboardInterrupt):
            t.merge(delta, "orderid", "orderdate")
    fresh = PartitionedTable(spark, t.root, "order_year", derive)
    assert rows(fresh) == before and fresh.current_version() == 0
    fresh.merge(delta, "orderid", "orderdate")  # the retry
    assert rows(fresh) == [("1", 2024, 10), ("2", 2023, 2), ("3", 2023, 3)]
    assert fresh.null_keys().count() == 1  # not set aside twice
    fresh.vacuum(keep=1)
    assert rows(fresh) == [("1", 2024, 10), ("2", 2023, 2), ("3", 2023, 3)]
    entry = fresh.log.read(1)
    named = {f.split("/")[0] for f in [*sum(entry["partitions"].values(), []), *entry["changes"], *entry["keyless"]]}
    assert set(fresh._children("", "_write")) == named  # the dead run's folders are gone


def test_a_reader_finishes_on_the_version_it_opened(spark):
    t = table(spark, "t-reader")
    t.overwrite(frame(spark, ("1", 2022, 1), ("2", 2023, 2)))
    open_before = t.read()
    t.merge(frame(spark, ("1", 2024, 10), ("2", 2023, 20)), "orderid", "orderdate")
    assert sorted(r["orderid"] + str(r["total"]) for r in open_before.collect()) == ["11.00", "22.00"]
    assert rows(t, 0) == [("1", 2022, 1), ("2", 2023, 2)] and rows(t) == [("1", 2024, 10), ("2", 2023, 20)]
    assert t.vacuum(keep=2) == [] and open_before.count() == 2


def test_of_two_writers_one_fails_cleanly(spark, monkeypatch):
    t = table(spark, "t-race")
    t.overwrite(frame(spark, ("1", 2022, 1), ("2", 2023, 2)))
    other = PartitionedTable(spark, t.root, "order_year", derive)
    real = PartitionedTable._write

    def write(self, df, head):  # the other writer commits while this one writes
        monkeypatch.setattr(PartitionedTable, "_write", real)
        other.merge(frame(spark, ("2", 2023, 99)), "orderid", "orderdate")
        return real(self, df, head)

    monkeypatch.setattr(PartitionedTable, "_write", write)
    with pytest.raises(CommitConflict):
        t.merge(frame(spark, ("1", 2024, 10)), "orderid", "orderdate")
    assert rows(t) == [("1", 2022, 1), ("2", 2023, 99)] and t.versions() == [0, 1]
    t.merge(frame(spark, ("1", 2024, 10)), "orderid", "orderdate")  # from the newer state
    assert rows(t) == [("1", 2024, 10), ("2", 2023, 99)]


def test_a_commit_number_is_made_once(spark):
    log = CommitLog(spark, scratch_dir(spark, "t-log"))
    assert log.latest() is None and log.commit(None, {"a": 1}) == 0
    with pytest.raises(CommitConflict):
        log.commit(None, {"a": 2})
    assert not log.fs.write_new(log.path(0), "{}") and log.read(0) == {"a": 1} and log.versions() == [0]


def test_many_small_merges_keep_few_folders(spark, monkeypatch):
    monkeypatch.setattr(partitioned, "MAX_FOLDERS", 3)
    t = table(spark, "t-folders")
    t.overwrite(frame(spark, ("0", 2023, 0)))
    for i in range(1, 8):
        assert t.merge(frame(spark, (str(i), 2023, i)), "orderid", "orderdate") == [2023]
        assert len(t.log.read(t.current_version())["partitions"]["order_year=2023"]) <= 4
    assert rows(t) == [(str(i), 2023, i) for i in range(8)]
    t.vacuum(keep=1)
    assert rows(t) == [(str(i), 2023, i) for i in range(8)]


def test_changes_are_signed_rows_between_versions(spark):
    t = table(spark, "t-changes")
    t.overwrite(frame(spark, ("1", 2022, 1), ("2", 2023, 2), ("3", 2023, 3)))
    t.merge(frame(spark, ("1", 2024, 10), ("4", 2024, 4)), "orderid", "orderdate")
    t.merge(frame(spark, ("1", 2025, 11)), "orderid", "orderdate")

    def net(df):
        out = Counter()
        for r in df.collect():
            out[(r["orderid"], r["order_year"], int(r["total"]))] += r["_sign"]
        return {k: v for k, v in out.items() if v}

    assert net(t.changes(1)) == {("1", 2024, 10): -1, ("1", 2025, 11): 1}
    assert net(t.changes(0)) == {("1", 2022, 1): -1, ("1", 2025, 11): 1, ("4", 2024, 4): 1}
    assert net(t.changes(0, 1)) == {("1", 2022, 1): -1, ("1", 2024, 10): 1, ("4", 2024, 4): 1}
    assert t.changes(2).count() == 0
    t.merge(frame(spark, ("2", 2023, 7)), "orderid", "orderdate", base=1)  # a merge may leave version 2 aside
    assert rows(t) == [("1", 2024, 10), ("2", 2023, 7), ("3", 2023, 3), ("4", 2024, 4)]
    assert t.changes(2) is None and net(t.changes(1)) == {("2", 2023, 2): -1, ("2", 2023, 7): 1}
    t.overwrite(frame(spark, ("9", 2020, 9)))
    assert t.changes(3) is None


def test_replace_takes_whole_partitions(spark):
    t = table(spark, "t-replace")
    t.overwrite(frame(spark, ("1", 2022, 1), ("2", 2023, 2), ("3", None, 3)))
    t.replace(frame(spark, ("5", 2023, 5)), [2023, None, 2030])
    assert rows(t) == [("1", 2022, 1), ("5", 2023, 5)]
    with pytest.raises(ValueError):
        t.replace(frame(spark, ("5", 2022, 5)), [2023])
    t.replace(frame(spark, ("5", 2023, 5)).limit(0), [2022, 2023])
    assert t.read().count() == 0 and t.read().columns == ["orderid", "orderdate", "total", "order_year"]


def test_first_merge_creates_the_table(spark):
    t = table(spark, "t-first")
    assert not t.exists() and t.read() is None and t.vacuum() == []
    assert t.merge(frame(spark, ("1", 2022, 1), ("1", 2023, 2)), "orderid", "orderdate") == []
    assert rows(t) == [("1", 2023, 2)]
