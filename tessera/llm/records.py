"""Token-id output as length-delimited binary records (operator 4).

Frame of one record, little-endian::

    u64 payload length | u32 masked CRC-32C of those 8 bytes
    payload | u32 masked CRC-32C of the payload | one line feed

with payload ``u8 has_id, i64 doc_id, u8 id width, ids``.  The line feed is
the row end of Spark's text sink, through which the frames are written, so
files are committed by Spark's output protocol on any file system it knows.
A separate Parquet index holds file, offset, length and counts per record,
for reads in any order.

Files hold ascending doc_ids; a null doc_id sorts first, equal doc_ids stay
together, a null or empty text holds only the end id.  Empty tables give no
records.  Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch
from tessera.llm.ship import ship
from tessera.llm.tokens import library_cache, vocab_size
from tessera.llm.words import slices, text_column

HEAD = "<BqB"
HEAD_BYTES = struct.calcsize(HEAD)
BLOCK = 256  # bytes whose checksums advance together


@functools.cache
def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """The byte table of CRC-32C (reflected polynomial 0x82F63B78), and four
    tables that move a checksum over BLOCK zero bytes."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0x82F63B78), t >> 1).astype(np.uint32)
    move = np.zeros((4, 256), np.uint32)
    for k in range(4):
        c = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(BLOCK):
            c = t[c & 0xFF] ^ (c >> np.uint32(8))
        move[k] = c
    return t, move


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of each byte string of at least four bytes, all at once."""
    t, move = _crc_tables()
    if not parts:
        return np.zeros(0, np.uint32)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    rows = -(-size // BLOCK)
    top = np.cumsum(rows) - rows
    grid = np.zeros(int(rows.sum()) * BLOCK, np.uint8)
    data = np.frombuffer(b"".join(parts), np.uint8)
    head = (top + rows) * BLOCK - size  # padded in front: leading zeros change nothing
    at = np.cumsum(size) - size
    grid[np.arange(len(data)) + np.repeat(head - at, size)] = data
    for k in range(4):
        grid[head + k] ^= 0xFF
    grid = np.ascontiguousarray(grid.reshape(-1, BLOCK).T)
    c = np.zeros(grid.shape[1], np.uint32)
    for column in grid:
        c = t[(c ^ column) & 0xFF] ^ (c >> np.uint32(8))
    out = c[top].copy()
    for k in range(1, int(rows.max())):
        m = np.flatnonzero(rows > k)
        x = out[m]
        out[m] = (move[0][x & 0xFF] ^ move[1][(x >> 8) & 0xFF] ^ move[2][(x >> 16) & 0xFF]
                  ^ move[3][x >> 24] ^ c[top[m] + k])
    return out ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and offset, so a checksum of data that holds checksums differs."""
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def frames(payloads: list[bytes]) -> list[bytes]:
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    a, b = masked(crc32c(heads)), masked(crc32c(payloads))
    return [h + x.tobytes() + p + y.tobytes() for h, x, p, y in zip(heads, a, payloads, b)]


def unframe(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, frame length, payload) of each record; raises on damage."""
    at, found = 0, []
    while at < len(data):
        n = struct.unpack_from("<Q", data, at)[0]
        end = at + 12 + n + 4
        if end >= len(data) or data[end] != 10:
            raise ValueError(f"damaged record at byte {at}")
        found.append((at, end + 1 - at, n))
        at = end + 1
    for i in range(0, len(found), 4096):
        some = found[i:i + 4096]
        heads = masked(crc32c([data[a:a + 8] for a, _, _ in some]))
        body = [data[a + 12:a + 12 + n] for a, _, n in some]
        sums = masked(crc32c(body))
        for (a, size, n), h, s, p in zip(some, heads.tolist(), sums.tolist(), body):
            if struct.unpack_from("<I", data, a + 8)[0] != h or struct.unpack_from("<I", data, a + 12 + n)[0] != s:
                raise ValueError(f"checksum differs at byte {a}")
            yield a, size, p


def payload_ids(payload: bytes) -> tuple[int | None, np.ndarray]:
    has, doc_id, width = struct.unpack_from(HEAD, payload)
    return (doc_id if has else None), np.frombuffer(payload, f"<u{width}", -1, HEAD_BYTES).astype("<u4")


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1,
                  text_bytes_per_file: int = 32 << 20) -> None:
    """Encode every text and write its record; files ascend by doc_id.

    The texts are range-partitioned before they are encoded, so each is
    encoded once.  A file holds about ``text_bytes_per_file`` of text.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1 + size // text_bytes_per_file, 2 * spark.sparkContext.defaultParallelism)
    width = 2 if vocab_size(tokenizer) <= 1 << 16 and end_id < 1 << 16 else 4

    def encode(batches):
        cache = library_cache(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, off = cache.encode(part.column("text"))
                ids = ids.astype(f"<u{width}")
                tail = np.array([end_id], f"<u{width}").tobytes()
                got = [struct.pack(HEAD, d is not None, d or 0, width) + ids[a:b].tobytes() + tail
                       for d, a, b in zip(part.column("doc_id").to_pylist(), off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(frames(got), pa.binary())], ["frame"])

    (docs.repartitionByRange(int(parts), "doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(encode, "frame binary")
     .select(F.col("frame").cast("string").alias("frame"))
     .write.option("lineSep", "\n").text(path))


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the files, verified: file, offset, n_bytes, doc_id,
    before (ids of earlier records in the file), n_tokens, ids_crc32."""
    def parse(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows, before = [], 0
                for at, size, payload in unframe(content.as_py()):
                    doc_id, ids = payload_ids(payload)
                    rows.append((name, at, size, doc_id, before, len(ids), zlib.crc32(ids.tobytes())))
                    before += len(ids)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t) for c, t in zip(zip(*rows), [pa.string()] + [pa.int64()] * 6)],
                        ["file", "offset", "n_bytes", "doc_id", "before", "n_tokens", "ids_crc32"])

    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select("path", "content")
            .mapInArrow(parse, "file string, offset long, n_bytes long, doc_id long, before long, "
                               "n_tokens long, ids_crc32 long"))


def build_index(scratch: Scratch, path: str) -> DataFrame:
    """The offset index as a written table, with each record's global start.

    Starts add up file totals in doc_id order: one row a file, never rows of
    documents, meets in the ordered window."""
    rows = scratch.save(scan_records(scratch.spark, path), "index")
    order = Window.orderBy(F.col("low").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = (rows.groupBy("file").agg(F.sum("n_tokens").alias("total"), F.min("doc_id").alias("lowest"),
                                      F.max(F.col("doc_id").isNull()).alias("none"))
             .withColumn("low", F.when(~F.col("none"), F.col("lowest")))
             .select("file", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("base")))
    return rows.join(files, "file").withColumn("start", F.col("base") + F.col("before")).drop("base", "before")


def read_records(spark: SparkSession, index: DataFrame) -> DataFrame:
    """doc_id and ids of the records that ``index`` names, in any order."""
    wanted = index.groupBy("file").agg(F.collect_list(F.struct("offset", "n_bytes")).alias("at"))
    paths = [r.file for r in wanted.select("file").toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], "doc_id long, ids array<long>")

    def cut_out(batches):
        for batch in batches:
            for content, spots in zip(batch.column("content"), batch.column("at").to_pylist()):
                data, got = content.as_py(), []
                for s in spots:
                    for _, _, payload in unframe(data[s["offset"]:s["offset"] + s["n_bytes"]]):
                        got.append(payload_ids(payload))
                yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()),
                                                  pa.array([g[1] for g in got], pa.list_(pa.int64()))], ["doc_id", "ids"])

    files = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), "content")
    return files.join(wanted, "file").select("content", "at").mapInArrow(cut_out, "doc_id long, ids array<long>")


def op4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ship(spark)
    scratch = Scratch(spark, "records")
    path = scratch.path("files")
    write_records(spark.read.parquet(f"{sf_dir}/documents.parquet"), path,
                  public_tokenizers.path("word_bpe_49k.json"))
    return build_index(scratch, path).select("doc_id", "start", "n_tokens", "ids_crc32")
