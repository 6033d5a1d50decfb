"""Lexical retrieval packing (operator 10).

Texts are encoded once and written as ids.  Whole windows at the front of a
long document are sequences of their own; its tail joins the pool.  Tails are
range-partitioned by a min-hash of their terms, so that texts with shared
words meet, and each task packs its rows in bounded shards: a shard is a BM25
inverted index over token ids.  A seed asks the index for unused neighbours,
best first, until its window is full; the last one is cut and its rest stays
in the pool.  What is left of a shard at its end is cut into sequences whose
lengths are powers of two, so no id is dropped and nothing is padded.

Document frequencies are those of the shard, as in a sharded search index.
The range key ends in the doc_id, so copies of one text, however many, spread
over shards.  A null or empty text is a document of its end id alone; a null
doc_id is kept; repeated rows are packed once each.  An empty table gives no
rows; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch
from tessera.llm.ship import ship
from tessera.llm.tokens import library_cache, vocab_size
from tessera.llm.words import U64, mix, slices, text_column

K1, B = 1.2, 0.75  # usual BM25 constants
QUERY_TERMS = 24   # a seed asks with its rarest terms
SHARD_DOCS, SHARD_IDS = 2048, 1 << 21


def id_width(tokenizer: str, end_id: int) -> int:
    return 2 if max(vocab_size(tokenizer) - 1, end_id) < 1 << 16 else 4


def encode_table(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, ids (little-endian, two bytes each if all ids fit, else four),
    key: a min-hash of the text's ids."""
    width = id_width(tokenizer, end_id)

    def encode(batches):
        cache = library_cache(tokenizer)
        scramble = mix(np.arange(max(vocab_size(tokenizer), end_id + 1)).astype(U64))
        for batch in batches:
            for part in slices(batch, "text"):
                ids, off = cache.encode(part.column("text"))
                n = len(off) - 1
                out = np.empty(len(ids) + n, f"<u{width}")
                doc = np.repeat(np.arange(n), np.diff(off))
                out[np.arange(len(ids)) + doc] = ids
                out[off[1:] + np.arange(n)] = end_id
                ends = off + np.arange(n + 1)
                key = np.minimum.reduceat(scramble[out], ends[:-1]) if n else np.zeros(0, U64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([out[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                     pa.array(key.astype(np.int64))], ["doc_id", "ids", "key"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs))
            .mapInArrow(encode, "doc_id long, ids binary, key long"))


class Bm25:
    """An inverted index over the term lists of one shard."""

    def __init__(self, docs: list[np.ndarray]):
        n = len(docs)
        size = np.fromiter(map(len, docs), np.int64, n)
        flat = np.concatenate(docs).astype(np.int64)
        pair, tf = np.unique((flat << 32) | np.repeat(np.arange(n), size), return_counts=True)
        self.doc = pair & 0xFFFFFFFF
        term = pair >> 32
        self.first = np.concatenate([[0], np.flatnonzero(term[1:] != term[:-1]) + 1, [len(term)]])
        df = np.diff(self.first)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * size / max(size.mean(), 1))
        self.weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm[self.doc])
        slot = np.repeat(np.arange(len(df)), df)
        order = np.lexsort((df[slot], self.doc))  # each document's terms, rarest first
        mine = df[slot[order]] > 1
        self.slot, owner = slot[order][mine], self.doc[order][mine]
        self.own = np.searchsorted(owner, np.arange(n + 1))
        self.n = n

    def neighbours(self, seed: int) -> list[int]:
        """Documents that share a rare term with the seed, best first."""
        terms = self.slot[self.own[seed]:self.own[seed + 1]][:QUERY_TERMS]
        if not len(terms):
            return []
        spans = [slice(self.first[t], self.first[t + 1]) for t in terms]
        docs = np.concatenate([self.doc[s] for s in spans])
        score = np.bincount(docs, np.concatenate([self.weight[s] for s in spans]), self.n)
        found = np.flatnonzero(score > 0)
        return found[np.argsort(-score[found], kind="stable")].tolist()


def pack_shard(docs: list[np.ndarray], window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that cover every id once."""
    out: list[list[tuple[int, int, int]]] = []
    done = [0] * len(docs)
    for i, ids in enumerate(docs):
        while len(ids) - done[i] >= window:
            out.append([(i, done[i], window)])
            done[i] += window
    pool = [i for i, ids in enumerate(docs) if len(ids) > done[i]]
    if not pool:
        return out
    index = Bm25([docs[i][done[i]:] for i in pool])
    waiting = iter(range(len(pool)))
    row: list[tuple[int, int, int]] = []
    room = window

    def take(k: int) -> None:
        nonlocal row, room
        i = pool[k]
        n = min(room, len(docs[i]) - done[i])
        if n:
            row.append((i, done[i], n))
            done[i] += n
            room -= n
        if not room:
            out.append(row)
            row, room = [], window

    for seed in waiting:
        if done[pool[seed]] == len(docs[pool[seed]]):
            continue
        take(seed)
        if row:
            before = len(out)
            for k in index.neighbours(seed):
                take(k)
                if len(out) > before:
                    break
        while done[pool[seed]] < len(docs[pool[seed]]):  # a cut seed's rest opens the next window
            take(seed)
    left, size = row, window - room
    while size:
        width, part = 1 << (size.bit_length() - 1), []
        need = width
        while need:
            i, at, n = left[0]
            n_now = min(n, need)
            part.append((i, at, n_now))
            left = left[1:] if n_now == n else [(i, at + n_now, n - n_now), *left[1:]]
            need -= n_now
        out.append(part)
        size -= width
    return out


def pack(encoded: DataFrame, width: int, window: int = 2048, parts: int | None = None) -> DataFrame:
    """Pieces of all documents of ``encoded`` (see ``encode_table``), whose
    ids have ``width`` bytes."""
    def task(batches):
        part, made = TaskContext.get().partitionId(), 0
        ids, docs, held = [], [], 0

        def flush():
            nonlocal made, ids, docs, held
            rows = []
            for seq in pack_shard(docs, window):
                at = 0
                for i, start, n in seq:
                    rows.append((ids[i], start, n, zlib.crc32(docs[i][start:start + n].astype("<u4").tobytes()), len(docs[i]),
                                 (part << 40) + made, at))
                    at += n
                made += 1
            ids, docs, held = [], [], 0
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            for k in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows[k:k + 50_000])], names)

        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                ids.append(doc_id)
                docs.append(np.frombuffer(raw.as_py(), f"<u{width}"))
                held += len(docs[-1])
                if len(docs) >= SHARD_DOCS or held >= SHARD_IDS:
                    yield from flush()
        if docs:
            yield from flush()

    n = parts or int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (encoded.repartitionByRange(n, "key", "doc_id").sortWithinPartitions("key", "doc_id").drop("key")
            .mapInArrow(task, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                              "sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, scratch: Scratch | None = None) -> DataFrame:
    scratch = scratch or Scratch(docs.sparkSession, "packing")
    return pack(scratch.save(encode_table(docs, tokenizer, end_id), "ids"), id_width(tokenizer, end_id), window)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ship(spark)
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          public_tokenizers.path("byte_bpe_50k.json"))
