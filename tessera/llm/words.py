"""Vectorised word, line and shingle hashing over Arrow text columns.

Words are ``[^\\x20\\x09-\\x0D]+``.  Every white-space byte is ASCII, so words
are found on the UTF-8 bytes directly; nulls count as empty texts.  Hashes are
64-bit and do not depend on the batch, so they can be shuffled and compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.default_rng(20240607)
#: A random odd 64-bit value for each byte, and the base of positions.
BYTE = _rng.integers(0, 2**63, 256, dtype=U64) * U64(2) + U64(1)
BASE = U64(0x9E3779B97F4A7C15)
SHINGLE = _rng.integers(0, 2**63, 64, dtype=U64) * U64(2) + U64(1)
#: Texts of one slice take about this many bytes (one long text may take more).
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (fixed multipliers)."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the n + 1 offsets into them."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts take about ``limit`` bytes."""
    _, off = text_bytes(batch.column(column))
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def segment_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range; ranges ascend and do not overlap."""
    if not len(start):
        return np.zeros(0, U64)
    lens = end - start
    pos = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
    idx = pos + np.repeat(start, lens)
    vals = BYTE[data[idx]] * powers(int(lens.max()))[pos]
    first = np.cumsum(lens) - lens
    out = np.zeros(len(start), U64)
    full = lens > 0
    if full.any():
        out[full] = np.add.reduceat(vals, first[full])
    return mix(out + lens.astype(U64) * SHINGLE[0])


@dataclass
class Words:
    data: np.ndarray      #: bytes of all texts
    off: np.ndarray       #: text i is data[off[i]:off[i + 1]]
    start: np.ndarray     #: first byte of each word
    end: np.ndarray       #: byte after each word
    doc: np.ndarray       #: text of each word
    first: np.ndarray     #: text i has words first[i]:first[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return segment_hash(self.data, self.start, self.end)


def find_words(col: pa.Array, lower: bool = False, gap: np.ndarray = SPACE) -> Words:
    """The words of all texts; ``gap`` says which bytes stand between words."""
    data, off = text_bytes(col)
    if lower:
        data = LOWER[data]
    word = ~gap[data]
    full = off[:-1] < off[1:]
    begin, last = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    heads, tails = off[:-1][full], off[1:][full] - 1
    begin[heads] = word[heads]
    last[tails] = word[tails]
    start, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
    first = np.searchsorted(start, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return Words(data, off, start, end, doc, first)


def windows(h: np.ndarray, k: int, base: np.uint64 = BASE) -> np.ndarray:
    """Unmixed polynomial hash of each run of ``k`` values, by doubling."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out, done, part, width = np.zeros(n, U64), 0, h, 1
    scale = powers(k + 1, base)
    while True:
        if k & width:
            out = out + part[done:done + n] * scale[done]
            done += width
        if done == k:
            return out
        part = part[:len(part) - width] + part[width:] * scale[width]
        width *= 2


def shingles(w: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each run of ``k`` words inside one text."""
    if len(h) < k:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    inside = w.doc[:len(h) - k + 1] == w.doc[k - 1:]
    return w.doc[:len(h) - k + 1][inside], mix(windows(h, k)[inside])


def whole(df):
    """All columns of each row as the struct ``whole``: operators that add
    columns of their own put them beside it, so no name can clash."""
    from pyspark.sql import functions as F
    return F.struct(*(df[c] for c in df.columns)).alias("whole")


def unpacked(df, columns: list[str], changed: dict):
    """The columns that ``whole`` holds, in their order, some replaced."""
    from pyspark.sql import functions as F
    return df.select(*(changed.get(c, F.col("whole")[c]).alias(c) for c in columns))


def text_column(df, name: str = "text"):
    """``name`` as a string column that is never null."""
    from pyspark.sql import functions as F
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
