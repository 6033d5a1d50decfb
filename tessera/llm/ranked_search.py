"""Ranked lexical search by NRA, reading impact-sorted lists in sequence
(operator 12).

1. The terms of the queries are numbered, in blocks of queries whose texts take
   at most ``QUERY_BYTES`` (a longer text is a block of its own): that is the
   only data broadcast.
2. One pass over the documents finds the query terms in each whole text (by
   64-bit hash, then byte by byte) and writes an index row: the document's
   length in terms and its (term, occurrences) pairs.  df, N and L are counted
   over all rows of that table.
3. Each task reads its part of the index in shards of bounded size and sorts
   every term's list by impact (the term's share of a score).  For a query it
   reads the lists of its terms in step, a block at a time, and keeps for each
   document met the sum of the impacts read (lower bound) and of those that
   its other lists can still hold, at most the last impact read there (upper
   bound).  Documents below the k-th lower bound are dropped, those that tie
   with it stay.  It reads on until no unread document can reach that bound
   and every document that stays has its final score: no list is entered at
   random.  The k-th score of a task's earlier shards is a bound for its later
   ones.
4. The tasks' k best per query meet in a window limited to k before its shuffle.

A text is not shuffled at all, and a document's rows never meet, so hot sources,
copies and repeated rows cost what other rows cost.

Terms are the maximal runs of ASCII letters and digits and of all characters
beyond ASCII, A-Z lower-cased.  Null and empty texts have no terms: such a
document counts nowhere, such a query has no rows.  Every row is a document or a
query of its own, also if ids repeat (their results repeat) or are null (null
ids come first among equal scores).  Empty tables give no rows.  Very long texts
count whole.  Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch
from tessera.llm.words import find_words, slices

#: Text of a block of queries, in bytes.
QUERY_BYTES = 16 << 20
#: A shard holds at most this many documents, postings (one document may hold
#: more) and cells of (term of a query, document).
SHARD_DOCS, SHARD_POSTINGS, SHARD_CELLS = 16_384, 4 << 20, 64 << 20
#: Entries that a list is read ahead first; each block is twice the one before.
FIRST_BLOCK = 64

#: Bytes that end a term; the others, and all beyond ASCII, are part of one.
GAP = np.ones(256, bool)
GAP[48:58] = GAP[65:91] = GAP[97:123] = False
GAP[128:] = False


def _verified(w, token: np.ndarray, vocab, code: np.ndarray) -> np.ndarray:
    """Which tokens equal the vocabulary's term ``code`` byte by byte."""
    lens = w.end[token] - w.start[token]
    same = lens == vocab.end[code] - vocab.start[code]
    token, code, lens = token[same], code[same], lens[same]
    if not len(token):
        return same
    first = np.cumsum(lens) - lens
    pos = np.arange(int(lens.sum())) - np.repeat(first, lens)
    equal = w.data[pos + np.repeat(w.start[token], lens)] == vocab.data[pos + np.repeat(vocab.start[code], lens)]
    same[same] = np.logical_and.reduceat(equal, first)
    return same


class Vocabulary:
    """The distinct terms of a block of queries, found by hash."""

    def __init__(self, texts: pa.Array):
        w = find_words(texts, lower=True, gap=GAP)
        h = w.hashes()
        words = [w.data[a:b].tobytes() for a, b in zip(w.start, w.end)]
        number = {t: i for i, t in enumerate(dict.fromkeys(words))}
        code = np.array([number[t] for t in words], np.int64)
        first = np.unique(code, return_index=True)[1]
        self.size = len(number)
        self.data, self.start, self.end = w.data, w.start[first], w.end[first]
        self.sorted = np.argsort(h[first], kind="stable")
        self.hashes = h[first][self.sorted]
        #: terms of one hash stand side by side; nearly always 1
        self.width = int(np.unique(self.hashes, return_counts=True)[1].max()) if self.size else 0
        #: distinct terms of each query
        self.queries = [np.unique(code[a:b]) for a, b in zip(w.first[:-1], w.first[1:])]

    def find(self, w) -> tuple[np.ndarray, np.ndarray]:
        """(token, term) of every token that is a term of the vocabulary."""
        h = w.hashes()
        spot = np.searchsorted(self.hashes, h)
        tokens, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(self.width):
            at = np.minimum(spot + k, self.size - 1)
            token = np.flatnonzero((spot + k < self.size) & (self.hashes[at] == h))
            term = self.sorted[at[token]]
            same = _verified(w, token, self, term)
            tokens.append(token[same])
            terms.append(term[same])
        return np.concatenate(tokens), np.concatenate(terms)


@dataclass
class Statistics:
    documents: int        #: N, documents with a term
    length: int           #: L, their terms
    weight: np.ndarray    #: of each term

    def share(self, n: np.ndarray) -> np.ndarray:
        """m of documents with ``n`` terms."""
        if 50 * int(n.max(initial=0)) * self.documents < 1 << 63:
            return 50 + 50 * n * self.documents // self.length
        return np.array([50 + 50 * int(v) * self.documents // self.length for v in n], np.int64)

    def impact(self, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m))


class Shard:
    """Impact-sorted lists of some documents."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int, terms: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, self.docs = doc[order], impact[order], docs
        self.first = np.searchsorted(term[order], np.arange(terms + 1))

    def top(self, query: np.ndarray, k: int, floor: int = 1, read: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of all documents that score at least as much as
        the k-th best and as ``floor``: more than k only where scores tie.
        ``read`` gets the entries read of each list."""
        at, end = self.first[query].copy(), self.first[query + 1]
        lower = np.zeros(self.docs, np.int64)
        seen = np.zeros((self.docs, len(query)), bool)
        met = np.zeros(self.docs, bool)
        alive = np.zeros(0, np.int64)                             # may still be among the best
        block, bound = FIRST_BLOCK, max(floor, 1)
        while True:
            last = np.zeros(len(query), np.int64)                 # the most that a list's unread entries hold
            fresh = []
            for i in np.flatnonzero(at < end):
                stop = min(at[i] + block, end[i])
                d = self.doc[at[i]:stop]
                lower[d] += self.impact[at[i]:stop]               # a document is once in a list
                seen[d, i] = True
                fresh.append(d[~met[d]])
                met[d] = True
                at[i] = stop
                if stop < end[i]:
                    last[i] = self.impact[stop - 1]
            block *= 2
            alive = np.concatenate([alive, *fresh])
            rest = ~seen[alive] @ last.astype(np.float64)         # whole numbers under 2^53: exact
            upper = lower[alive] + rest.astype(np.int64)
            if len(alive) >= k:
                bound = max(bound, int(np.partition(lower[alive], len(alive) - k)[len(alive) - k]))
            stays = upper >= bound
            alive, upper = alive[stays], upper[stays]
            if int(last.sum()) < bound and (upper == lower[alive]).all():
                if read is not None:
                    read.append(at - self.first[query])
                return alive, lower[alive]


def index(documents: DataFrame, vocab, scratch: Scratch) -> DataFrame:
    """doc_id, n and the query terms of every document that has a term."""
    def run(batches):
        v = vocab.value
        for batch in batches:
            for part in slices(batch, "text"):
                w = find_words(part.column("text"), lower=True, gap=GAP)
                token, term = v.find(w)
                pair, tf = np.unique(w.doc[token] * max(v.size, 1) + term, return_counts=True)
                doc, term = np.divmod(pair, max(v.size, 1))
                ends = pa.array(np.searchsorted(doc, np.arange(part.num_rows + 1)), pa.int32())
                out = pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(w.counts, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))], ["doc_id", "n", "terms", "tfs"])
                yield out.filter(pa.array(w.counts > 0))

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scratch.save(rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>"), "index")


def _best(doc_id: np.ndarray, known: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((doc_id, known, -score))[:k]


def _search(vocab, stats, k: int):
    def run(batches):
        v, s = vocab.value, stats.value
        widest = max((len(q) for q in v.queries), default=0)
        most = max(1, min(SHARD_DOCS, SHARD_CELLS // max(widest, 1)))
        best = {}

        def search(rows: list[pa.RecordBatch]):
            table = pa.Table.from_batches(rows).combine_chunks()
            ids = table.column("doc_id").combine_chunks()
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            terms, tfs = (table.column(c).combine_chunks() for c in ("terms", "tfs"))
            doc = np.repeat(np.arange(len(ids)), terms.value_lengths().to_numpy(zero_copy_only=False))
            term = terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            tf = tfs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            m = s.share(table.column("n").to_numpy())
            impact = s.impact(term, tf, m[doc])
            some = impact > 0
            shard = Shard(doc[some], term[some], impact[some], len(ids), v.size)
            for q, query in enumerate(v.queries):
                old = best.get(q)
                floor = int(old[2][-1]) if old is not None and len(old[2]) == k else 1
                found, score = shard.top(query, k, floor)
                if len(found):
                    new = (ids[found], known[found], score)
                    if old is not None:
                        new = tuple(np.concatenate(two) for two in zip(old, new))
                    pick = _best(*new, k)
                    best[q] = tuple(c[pick] for c in new)

        rows, postings = [], 0
        for batch in batches:
            while batch.num_rows:
                sizes = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
                room = min(most - sum(r.num_rows for r in rows), max(1, int(np.searchsorted(sizes, SHARD_POSTINGS - postings, side="right"))))
                rows.append(batch.slice(0, room))
                postings += int(sizes[min(room, len(sizes)) - 1])
                batch = batch.slice(room)
                if postings >= SHARD_POSTINGS or sum(r.num_rows for r in rows) >= most or batch.num_rows:
                    search(rows)
                    rows, postings = [], 0
        if rows:
            search(rows)
        for q, (ids, known, score) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), q, np.int32)), pa.array(ids, mask=~known), pa.array(score)],
                                             ["q", "doc_id", "score"])
    return run


def _query_blocks(queries: DataFrame, scratch: Scratch):
    """The queries as Arrow tables of at most about QUERY_BYTES of text."""
    rows = queries.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // QUERY_BYTES)
    if blocks > 1:
        rows = scratch.save(rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(2 * blocks))), "queries")
    for b in range(2 * blocks if blocks > 1 else blocks):
        yield (rows.where(F.col("block") == b).drop("block") if blocks > 1 else rows).toArrow()


def rank(documents: DataFrame, queries: DataFrame, k: int = 50, scratch: Scratch | None = None) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each query."""
    scratch = scratch or Scratch(documents.sparkSession, "ranked-search")
    spark = scratch.spark
    out = None
    for table in _query_blocks(queries, scratch):
        vocab = Vocabulary(table.column("text").combine_chunks())
        if not vocab.size:
            continue
        words = spark.sparkContext.broadcast(vocab)
        rows = index(documents, words, scratch)
        n, length = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n:
            continue
        weight = np.zeros(vocab.size, np.int64)
        for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # terms of the block's queries
            weight[r[0]] = math.floor(1000 * math.log((2 * n + 2) / (2 * r[1] + 1)))
        stats = spark.sparkContext.broadcast(Statistics(n, length, weight))
        found = scratch.save(rows.mapInArrow(_search(words, stats, k), "q int, doc_id long, score long"), "found")
        scratch.drop(rows)
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ids = table.column("item_id").to_pylist()
        names = spark.createDataFrame(list(enumerate(ids)), "number int, item_id long")  # bounded with the block
        part = (ranked.join(F.broadcast(names), ranked["q"] == names["number"]).select("item_id", "rank", "doc_id", "score"))
        out = part if out is None else out.unionAll(part)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def op12_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: Every score of every document.
ORACLE = r"""
WITH term AS (
  SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents
  UNION ALL
  SELECT 'q', item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) FROM benchmark
), tf AS (
  SELECT id AS doc_id, t, count(*) AS tf FROM term WHERE kind = 'd' GROUP BY ALL
), doc AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id
), total AS (
  SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM doc
), weight AS (
  SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY t, nn
), impact AS (
  SELECT tf.doc_id, tf.t, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll))) AS impact
  FROM tf JOIN doc ON doc.doc_id = tf.doc_id JOIN weight ON weight.t = tf.t, total
), score AS (
  SELECT q.id AS item_id, i.doc_id, sum(impact)::BIGINT AS score
  FROM (SELECT DISTINCT id, t FROM term WHERE kind = 'q') q JOIN impact i ON i.t = q.t GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM score WHERE score > 0
QUALIFY rank <= 50
"""
