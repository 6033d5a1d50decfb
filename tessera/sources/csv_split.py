"""Read CSV files with quoted newlines in parallel, by the parity of quotes.

Spark's ``multiLine`` reader gives a file to one task, however large it is: a
newline ends a record only outside quotes, and a task that starts in the middle
of a file cannot know which it sees.  But that is just the parity of the quotes
before it:

1. files are read as lines, in splits of ``spark.sql.files.maxPartitionBytes``;
   one aggregate counts the quotes of each split;
2. a running sum over the splits of a file (one small row each) says which splits
   start or end inside a quoted cell.  Their 64-bit hashes are broadcast: 8 bytes
   for a split of input, so 100 TB in 128 MB splits are some 6 MB at most;
3. each split cuts its lines into records where the parity is even.  Records
   within a split go on without a shuffle; only the at most two fragments of a
   split that belong to records across its edges are grouped by file and put
   together, by a second scan that drops all other splits at once.

Records are what RFC 4180 calls so: cells with quotes are quoted whole, quotes
inside are doubled.  A record that breaks this (a quote inside an unquoted cell,
or one that is never closed) is not guessed at: it comes with all its text in
the corrupt column, like a ragged row, and so is quarantined.  Line ends are
``\\n`` or ``\\r\\n``; as with the multiLine reader, a record that ends in the
latter has its newlines inside quotes as ``\\n`` (of a file's last record that
has no line end they stay as they are).  Empty lines are skipped.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, FRAGMENT = 0, 1
_CELL = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
#: A record whose quotes are where they may be (fixed: comma and double quote).
REGULAR = re.compile(f"{_CELL}(?:,{_CELL})*+")


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, start (of the split), split (its hash) and value, in file order."""
    df = spark.read.option("lineSep", "\n").text(paths)
    return (df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
            .select("path", "start", F.xxhash64("path", "start").alias("split"), "value"))


def _quotes() -> F.Column:
    return F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))


def split_states(rows: DataFrame) -> DataFrame:
    """One row per split: whether it starts (``odd``) and ends inside quotes."""
    counts = rows.groupBy("path", "start", "split").agg(F.sum(_quotes()).alias("n"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1
    return counts.withColumn("odd", odd).withColumn("ends_odd", (F.col("odd").cast("int") + F.col("n")) % 2 == 1)


class Cutter:
    """Cuts the lines of one split into records."""

    def __init__(self, start: int, odd: bool):
        self.odd = odd                      # inside quotes at the next line
        self.open = [] if odd else None     # lines of the record that is not complete
        self.inherited = odd                # its beginning is in an earlier split
        self.header = start == 0            # the file's first record is still to come

    def cut(self, value: pa.Array) -> tuple[list[str], list[tuple[bool, str]]]:
        """(records, fragments (begins here, text)) that these lines complete."""
        n = pc.count_substring(value, '"').to_numpy(zero_copy_only=False)
        after = (self.odd + np.cumsum(n)) % 2 == 1
        before = np.concatenate([[self.odd], after[:-1]])
        if not len(n):
            return [], []
        self.odd = bool(after[-1])
        text = value.to_pylist()
        if not (before | after).any() and self.open is None:
            records = text
        else:
            records, fragments = [], []
            for line, inside, stays in zip(text, before, after):
                if not inside:
                    self.open, self.inherited = [], False
                self.open.append(line)
                if not stays:
                    whole = "\n".join(self.open)
                    if self.inherited:
                        fragments.append((False, whole))
                    else:
                        records.append(whole)
                    self.open = None
            return self._rest(records), fragments
        return self._rest(records), []

    def _rest(self, records: list[str]) -> list[str]:
        if self.header and records:
            self.header = False
            return records[1:]
        return records

    def end(self) -> list[tuple[bool, str]]:
        return [] if self.open is None else [(not self.inherited, "\n".join(self.open))]


def _records(odd, wanted: int):
    def run(batches):
        current = cutter = path = start = None
        for batch in batches:
            splits = batch.column("split").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(splits)) + 1), len(splits)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                out = []
                if splits[a] != current:
                    out += [(path, start, 2, *f) for f in (cutter.end() if cutter else [])]
                    current, path, start = splits[a], batch.column("path")[a].as_py(), batch.column("start")[a].as_py()
                    at = np.searchsorted(odd.value, current)
                    cutter = Cutter(start, bool(at < len(odd.value) and odd.value[at] == current))
                whole, parts = cutter.cut(batch.column("value").slice(a, b - a))
                out += [(path, start, 1, *f) for f in parts]
                if wanted == WHOLE:
                    yield _batch([(path, start, 0, True, r) for r in whole])
                elif out:
                    yield _batch(out)
        if cutter and wanted == FRAGMENT:
            yield _batch([(path, start, 2, *f) for f in cutter.end()])
    return run


SHAPE = "path string, start long, part int, begins boolean, record string"
_ARROW = pa.schema([("path", pa.string()), ("start", pa.int64()), ("part", pa.int32()), ("begins", pa.bool_()), ("record", pa.string())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _mark_irregular(batches):
    for batch in batches:
        texts = batch.column("record").to_pylist()
        fine = [t is None or '"' not in t or REGULAR.fullmatch(t) is not None for t in texts]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fine, pa.bool_())], [*batch.schema.names, "regular"])


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, record and whether it is regular, for every record of the files
    but their header lines."""
    rows = lines(spark, paths)
    crossed = split_states(rows).where("odd or ends_odd").select("split", "odd").collect()
    odd = spark.sparkContext.broadcast(np.array(sorted(r["split"] for r in crossed if r["odd"]), np.int64))
    out = rows.mapInArrow(_records(odd, WHOLE), SHAPE).select("path", "record")
    if crossed:
        # the same scan again (fewer files would be cut into other splits), kept to the splits that a record crosses
        marks = spark.createDataFrame([(r["split"],) for r in crossed], "crossed long")
        again = rows.join(F.broadcast(marks), rows["split"] == marks["crossed"]).select(*rows.columns)
        parts = again.mapInArrow(_records(odd, FRAGMENT), SHAPE)
        order = Window.partitionBy("path").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, 0)
        joined = (parts.withColumn("number", F.sum(F.col("begins").cast("int")).over(order)).groupBy("path", "number")
                  .agg(F.sort_array(F.collect_list(F.struct("start", "part", "record"))).alias("parts"))
                  .select("path", F.array_join(F.col("parts.record"), "\n").alias("record")))
        out = out.unionByName(joined)
    unix = F.replace(F.substr("record", F.lit(1), F.length("record") - F.lit(1)), F.lit("\r\n"), F.lit("\n"))
    bare = out.select("path", F.when(F.endswith("record", F.lit("\r")), unix).otherwise(F.col("record")).alias("record")).where("record != ''")
    return bare.mapInArrow(_mark_irregular, "path string, record string, regular boolean")


def read_split(spark: SparkSession, paths: list[str], columns: list[str], options: dict[str, str], corrupt: str) -> DataFrame:
    """The cells of every record as text, ``corrupt`` and ``source_name``."""
    schema = ", ".join(f"`{c}` string" for c in [*columns, corrupt])
    keep = {k: v for k, v in options.items() if k not in ("header", "multiLine", "encoding")}
    cells = F.from_csv("record", schema, keep)
    rows = read_records(spark, paths).select("path", "record", "regular", cells.alias("cells"))
    one = [F.when(F.col("regular"), F.col("cells")[c]).alias(c) for c in columns]
    bad = F.when(F.col("regular"), F.col("cells")[corrupt]).otherwise(F.col("record"))
    return rows.select(*one, bad.alias(corrupt), F.element_at(F.split("path", "/"), -1).alias("source_name"))
