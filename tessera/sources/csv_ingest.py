"""Land delimited files into raw tables against their contracts.

Flow for one landing folder:

1. ``list_inputs``  - files whose last suffix is ``csv`` or ``txt`` (case
   sensitive), either directly in the folder (routed by file stem:
   ``orders.csv`` -> ``orders_raw``) or one level down in a folder named
   after the stem (``orders/part-0001.csv``), the shape of multi-file
   daily deliveries.
2. ``build_manifest`` - one header line per file (metadata only) decides
   acceptance: the header must hold the contract's columns, each once, in
   any order and case; empty files, unknown stems and other headers are
   rejected as a whole, and the run goes on with the other files.
3. ``read_files``  - files are grouped by header order and each group is read
   by Spark's CSV source in parallel with an explicit all-text schema in
   *file* order, then selected by name (Spark binds CSV columns by
   position).  Doubled quotes are the escape; ragged rows are caught in
   ``_corrupt_record``.
4. ``validate``    - per row: malformed, NOT NULL key missing, DATE column
   not in the contract format, number that does not cast.  Every input row ends up
   either loaded or quarantined with its original cells and a reason.
5. ``ingest``      - one write per table, partitioned by load run,
   ``ingest_status`` and (for tables with a date partition) year, so loaded
   and quarantined rows come out of a single pass over the files, and a
   retried run replaces only its own partition.
"""

from __future__ import annotations

import csv
import io
import re
from collections import defaultdict
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import utc_now
from pyspark.sql import types as T

from tessera.contracts import CONTRACTS, Contract
from tessera.functions.dates import spark_pattern
from tessera.sources.csv_split import read_split
from tessera.sources.fs import HadoopFS

# Accepted file suffixes and lineage columns.
SUPPORTED_SUFFIXES = ("csv", "txt")
CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class InputFile:
    path: str
    name: str
    stem: str
    table: str
    header: tuple[str, ...] | None
    accepted: bool
    reason: str


def _suffix(name: str) -> str:
    return name.rsplit(".", 1)[-1] if "." in name else ""


def _stem(name: str) -> str:
    return name.rsplit(".", 1)[0] if "." in name else name


def list_inputs(spark: SparkSession, landing: str,
                contracts: dict[str, Contract] = CONTRACTS) -> list[tuple[str, str]]:
    """(path, stem) of every candidate file, sorted by path."""
    fs = HadoopFS(spark)
    stems = {c.stem for c in contracts.values()}
    out = []
    for path, is_dir in fs.list(landing):
        name = path.rstrip("/").rsplit("/", 1)[-1]
        if is_dir:
            if name in stems:
                for sub, sub_is_dir in fs.list(path):
                    sub_name = sub.rsplit("/", 1)[-1]
                    if not sub_is_dir and _suffix(sub_name) in SUPPORTED_SUFFIXES:
                        out.append((sub, name))
        elif _suffix(name) in SUPPORTED_SUFFIXES:
            out.append((path, _stem(name)))
    return sorted(out)


def _parse_header(line: str | None) -> tuple[str, ...] | None:
    if line is None:
        return None
    line = line.lstrip("﻿")
    row = next(csv.reader(io.StringIO(line)), None)
    return tuple(h.strip() for h in row) if row else None


def read_headers(spark: SparkSession, paths: list[str], threads: int = 32) -> list:
    """First line of each file, read concurrently (I/O bound metadata reads:
    one small read per file, never the data)."""
    from concurrent.futures import ThreadPoolExecutor
    fs = HadoopFS(spark)
    if len(paths) <= 1:
        return [_parse_header(fs.first_line(p)) for p in paths]
    with ThreadPoolExecutor(max_workers=min(threads, len(paths))) as pool:
        return list(pool.map(lambda p: _parse_header(fs.first_line(p)), paths))


def header_problem(header: tuple[str, ...] | None, contract: Contract | None, table: str) -> str | None:
    """Why a file with this header cannot be loaded, or None."""
    if header is None:
        return "empty file"
    if contract is None:
        return f"no contract for table {table}"
    got, want = [h.lower() for h in header], set(contract.names)
    twice = sorted({h for h in got if got.count(h) > 1})
    if twice:
        return f"columns repeated: {twice}"
    if set(got) != want:
        return f"columns mismatch: missing {sorted(want - set(got))}, unexpected {sorted(set(got) - want)}"
    return None


def build_manifest(spark: SparkSession, landing: str,
                   contracts: dict[str, Contract] = CONTRACTS) -> list[InputFile]:
    inputs = list_inputs(spark, landing, contracts)
    headers = read_headers(spark, [p for p, _ in inputs])
    entries = []
    for (path, stem), header in zip(inputs, headers):
        table = f"{stem}_raw"
        problem = header_problem(header, contracts.get(table), table)
        entries.append(InputFile(path, path.rsplit("/", 1)[-1], stem, table,
                                 header, problem is None, problem or "accepted"))
    return entries


MANIFEST_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("columns", T.StringType()), T.StructField("accepted", T.BooleanType()),
    T.StructField("reason", T.StringType())])


def manifest_frame(spark: SparkSession, entries: list[InputFile]) -> DataFrame:
    """The manifest (one row per file, metadata only) as a DataFrame."""
    rows = [(e.name, e.table, ",".join(e.header or ()), e.accepted, e.reason) for e in entries]
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def csv_options(contract: Contract) -> dict[str, str]:
    """The source system's CSV dialect, for batch and stream readers alike."""
    return {"header": "true", "sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8",
            "multiLine": str(contract.multi_line).lower(), "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT,
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def file_schema(header: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(h.lower(), T.StringType(), True) for h in header]
                        + [T.StructField(CORRUPT, T.StringType(), True)])


def read_files(spark: SparkSession, contract: Contract, entries: list[InputFile], split: bool = False) -> DataFrame | None:
    """Accepted files of one table, columns mapped by name, all text.

    ``split`` reads files with quoted newlines by many tasks
    (:mod:`tessera.sources.csv_split`), else each of them is one task's."""
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for e in entries:
        if e.accepted and e.table == contract.table:
            groups[tuple(h.lower() for h in e.header)].append(e.path)
    frames = []
    for header, paths in sorted(groups.items()):
        if split and contract.multi_line:
            df = read_split(spark, paths, list(header), csv_options(contract), CORRUPT)
            frames.append(df.select(*contract.names, CORRUPT, "source_name"))
            continue
        df = spark.read.schema(file_schema(header)).options(**csv_options(contract)).csv(paths)
        frames.append(df.select(*[F.col(c) for c in contract.names], F.col(CORRUPT),
                                F.col("_metadata.file_name").alias("source_name")))
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def positional_schema(contract: Contract) -> T.StructType:
    """``c0 .. cN-1`` text columns: a file read before its header is known."""
    return T.StructType([T.StructField(f"c{i}", T.StringType(), True)
                         for i in range(len(contract.columns))]
                        + [T.StructField(CORRUPT, T.StringType(), True)])


def map_by_header(spark: SparkSession, df: DataFrame, contract: Contract,
                  path_col: str = "_file_path") -> tuple[DataFrame | None, list[InputFile]]:
    """Name the positional columns of ``df`` by each file's own header.

    Only the header line of each distinct file in ``df`` is read (metadata,
    bounded by the number of files in one batch).  Files whose header does
    not hold the contract's column set are left out and reported.
    """
    paths = sorted(r[0] for r in df.select(path_col).distinct().collect())
    layouts: dict[tuple[str, ...], list[str]] = defaultdict(list)
    report = []
    # Spark reports paths percent-encoded; the file system wants them plain.
    for p, header in zip(paths, read_headers(spark, [unquote(p) for p in paths])):
        problem = header_problem(header, contract, contract.table)
        report.append(InputFile(unquote(p), unquote(p).rsplit("/", 1)[-1], contract.stem, contract.table, header,
                                problem is None, problem or "accepted"))
        if problem is None:
            layouts[tuple(h.lower() for h in header)].append(p)
    frames = []
    for header, files in sorted(layouts.items()):
        pos = {name: i for i, name in enumerate(header)}
        frames.append(df.where(F.col(path_col).isin(files)).select(
            *[F.col(f"c{pos[n]}").alias(n) for n in contract.names], CORRUPT, "source_name"))
    if not frames:
        return None, report
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out, report


def normalize_date(col, contract_format: str):
    """Loader date normaliser: text in ``contract_format`` -> ISO ``yyyy-MM-dd``
    text; NULL when it does not parse (the row is then quarantined)."""
    return F.date_format(F.try_to_date(col, spark_pattern(contract_format)), "yyyy-MM-dd")


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """Add ``_reject_reason`` (NULL = valid) and type DATE contract columns."""
    reasons = [F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed row"))]
    typed = []
    for c in contract.columns:
        col = F.col(c.name)
        if c.not_null:
            reasons.append(F.when(col.isNull(), F.lit(f"{c.name}: required value missing")))
        if c.format and c.type != "string":
            # Only typed (DATE) columns are converted and checked on landing;
            # a format on a text column is documentation (the contract
            # profile reports whether the data follows it).
            parsed = F.try_to_date(col, spark_pattern(c.format))
            reasons.append(F.when(col.isNotNull() & parsed.isNull(),
                                  F.lit(f"{c.name}: not a {c.format} value")))
            typed.append(parsed.cast(c.type).alias(c.name))
        else:
            if c.cast_to:
                reasons.append(F.when(col.isNotNull() & col.try_cast(c.cast_to).isNull(),
                                      F.lit(f"{c.name}: not a {c.cast_to} value")))
            typed.append(col.cast(c.type).alias(c.name) if c.type != "string" else col)
    reason = F.coalesce(*reasons)
    original = F.struct(*[F.col(c.name) for c in contract.columns])
    return df.select(*typed, "source_name", reason.alias("_reject_reason"),
                     F.when(reason.isNotNull(), original).alias("_original"),
                     F.col(CORRUPT).alias("_raw_line"))


def landed(df: DataFrame, contract: Contract) -> DataFrame:
    """Validated rows with lineage, status and (for dated tables) year."""
    out = df.select("*",
                    utc_now().alias("insert_date"),
                    F.when(F.col("_reject_reason").isNull(), "loaded")
                     .otherwise("quarantined").alias("ingest_status"))
    if contract.partition_by_year_of:
        out = out.withColumn("order_year", F.year(contract.partition_by_year_of))
    return out


def partition_columns(contract: Contract) -> list[str]:
    return ["ingest_status"] + (["order_year"] if contract.partition_by_year_of else [])


def new_run_id() -> str:
    import datetime as _dt
    import uuid
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def write_manifest(spark: SparkSession, lake: str, run_id: str, entries: list[InputFile]) -> None:
    """Add one run's file report to ``<lake>/_manifest``; a retry replaces it."""
    if entries:
        (manifest_frame(spark, entries).select(F.lit(run_id).alias("ingest_run"), "*",
                                               utc_now().alias("ingested_at")).coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("ingest_run").parquet(f"{lake.rstrip('/')}/_manifest"))


def write_landed(rows: DataFrame, contract: Contract, lake: str, run_id: str) -> None:
    """Write one run's validated rows to its own partition of the raw table.

    Batch and stream runs share the layout.  The rebalance gives each
    partition files of a good size instead of one per task."""
    out = landed(rows, contract).withColumn("ingest_run", F.lit(run_id))
    by = partition_columns(contract)
    (out.hint("rebalance", *map(F.col, by))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ingest_run", *by).parquet(f"{lake.rstrip('/')}/{contract.table}"))


def ingest(spark: SparkSession, landing: str, lake: str,
           contracts: dict[str, Contract] = CONTRACTS, run_id: str | None = None, split: bool = False) -> dict:
    """Ingest every accepted file under ``landing`` into ``<lake>/<table>``.

    Each run writes its own ``ingest_run=<run_id>`` partition with dynamic
    partition overwrite: retrying a run (same ``run_id``) after a failure
    replaces that run's output instead of appending a second copy, and
    never touches earlier runs.  The manifest (one row per file: accepted or
    why not) is appended to ``<lake>/_manifest`` as an audit trail.  ``split``
    lets many tasks read one file whose cells hold newlines.  Returns
    the run id, the manifest entries and the tables written.
    """
    run_id = run_id or new_run_id()
    entries = build_manifest(spark, landing, contracts)
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
        raise ValueError(f"a run id is letters, digits, dots, dashes and underscores: {run_id!r}")
    write_manifest(spark, lake, run_id, entries)
    written = []
    for contract in contracts.values():
        df = read_files(spark, contract, entries, split)
        if df is not None:
            write_landed(validate(df, contract), contract, lake, run_id)
            written.append(contract.table)
    return {"run_id": run_id, "manifest": entries, "tables": written}


def read_manifest(spark: SparkSession, lake: str) -> DataFrame:
    """One row per file and run: accepted, or why not.  Run ids stay text."""
    schema = T.StructType([*MANIFEST_SCHEMA.fields, T.StructField("ingested_at", T.TimestampNTZType()),
                           T.StructField("ingest_run", T.StringType())])
    return spark.read.schema(schema).parquet(f"{lake.rstrip('/')}/_manifest")


def read_raw(spark: SparkSession, lake: str, table: str) -> DataFrame:
    """Loaded rows of a raw table (partition-pruned to ``ingest_status=loaded``)."""
    contract = CONTRACTS[table]
    df = spark.read.parquet(f"{lake.rstrip('/')}/{table}")
    return (df.where(F.col("ingest_status") == "loaded")
              .select(*contract.names, "source_name", "insert_date"))


def read_quarantine(spark: SparkSession, lake: str, table: str) -> DataFrame:
    """Rejected rows with their original cells and the reason."""
    df = spark.read.parquet(f"{lake.rstrip('/')}/{table}")
    return (df.where(F.col("ingest_status") == "quarantined")
              .select("_original.*", F.col("_reject_reason").alias("reject_reason"),
                      F.col("_raw_line").alias("raw_line"), "source_name"))


def export_quarantine(spark: SparkSession, lake: str, table: str, out: str) -> None:
    """Write a table's rejected rows as CSV under the original header (the
    error file of the source loader), to a folder apart from the inputs so
    the next run never lists it as a delivery."""
    contract = CONTRACTS[table]
    rows = read_quarantine(spark, lake, table).select(*contract.names)
    (rows.write.mode("overwrite").option("header", True).option("quote", '"')
         .option("escape", '"').csv(out))


def raw_from_lake(spark: SparkSession, lake: str,
                  contracts: dict[str, Contract] = CONTRACTS) -> dict[str, DataFrame]:
    """Loaded rows of every raw table present in ``lake``, keyed by table."""
    fs = HadoopFS(spark)
    return {name: read_raw(spark, lake, name) for name in contracts
            if fs.exists(f"{lake.rstrip('/')}/{name}")}
