"""MinHash near-duplicates (operator 9).

1. One pass hashes the word shingles of each whole text: the set's size, a
   128-bit sum that names the set, and minima of many universal hashes.
2. Texts with equal sets form a class, named by the number of one of its rows
   in the written table, so copies, however many, cost one row from here on.
3. Bands of the minima put classes into buckets.  Inside a bucket signatures
   are compared, and what agrees well enough is joined by a spanning forest:
   a bucket gives fewer edges than it has rows, never its pairs.  Components
   of these edges (large-star, small-star) are the candidate groups.
4. The full shingle sets of each candidate group are compared; again only a
   spanning forest of the confirmed links leaves a task.  Each text travels
   once for a group, not once for a pair.
5. Components of the confirmed links, again by the stars.

Buckets and groups beyond ``BLOCK`` rows are split by hash into blocks, and
each pair of blocks is a task of its own, so no task holds a large group.

With 48 bands of 6 minima a pair at 0.85 misses all buckets with probability
1e-10 (at 0.8: 5e-7); the signature test lets a pair at the threshold fail
beyond 5.5 standard deviations only.

Null, empty and blank texts have no set: no links, a component of their own.
Texts of fewer than ``size`` words have their whole sequence as one shingle.
Rows of equal doc_id are texts of their own, which may belong to different
groups; each keeps its row, and ``kept`` is true for all that carry the smallest
doc_id of their group.  ``distinct_documents`` keeps one row of each group and of
repeated rows.  A null doc_id is kept and links with nothing.  Empty tables give
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.scratch import Scratch
from tessera.llm.words import U64, find_words, mix, shingles, slices, text_column, unpacked, whole, windows

BANDS, ROWS = 48, 6
BLOCK = 256
#: Texts are looked up by ids; their hashes fall into so many cells, a set of
#: which is small enough to broadcast whatever the corpus holds.
CELLS = 1 << 20
_rng = np.random.default_rng(85)
#: Multiply-add hash functions on 64-bit values; the top bits are used.
A = _rng.integers(0, 2**63, BANDS * ROWS, dtype=U64) * U64(2) + U64(1)
C = _rng.integers(0, 2**63, BANDS * ROWS, dtype=U64)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, shingle) pairs, by text."""
    w = find_words(texts, lower=True)
    h = w.hashes()
    doc, s = shingles(w, h, size)
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    if len(short):
        one = [mix(windows(h[w.first[i]:w.first[i + 1]], int(w.counts[i])))[0] for i in short]
        doc, s = np.concatenate([doc, short]), np.concatenate([s, np.array(one, U64)])
    order = np.lexsort((s, doc))
    doc, s = doc[order], s[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], s[new]


def sliced_sets(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`shingle_sets` of a batch's texts, slice by slice: what hashing
    needs for each byte of text is held for one slice only."""
    docs, sets, row = [np.zeros(0, np.int64)], [np.zeros(0, U64)], 0
    for part in slices(batch, "text"):
        doc, s = shingle_sets(part.column("text"), size)
        docs.append(doc + row)
        sets.append(s)
        row += part.num_rows
    return np.concatenate(docs), np.concatenate(sets)


def signatures(doc: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Minima of all hash functions, a row for each text that has a set."""
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    out = np.empty((len(first), len(A)), U64)
    for k in range(len(A)):
        out[:, k] = np.minimum.reduceat(s * A[k] + C[k], first)
    return out >> U64(32)


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_lo and set_hi (null without a set),
    signature (8 bits a function), bands."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                doc, s = shingle_sets(part.column("text"), size)
                n = part.num_rows
                count = np.bincount(doc, minlength=n)
                lo, hi = np.zeros(n, U64), np.zeros(n, U64)
                sig, bands = [None] * n, [None] * n
                if len(s):
                    at = np.flatnonzero(count)
                    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                    lo[at] = np.add.reduceat(mix(s), first)
                    hi[at] = np.add.reduceat(mix(s ^ U64(0x5851F42D4C957F2D)), first)
                    m = signatures(doc, s)
                    band = np.zeros((len(m), BANDS), U64)
                    for k in range(ROWS):
                        band = mix(band + m[:, k::ROWS] + U64(1))
                    band = mix(band + np.arange(BANDS, dtype=U64)).astype(np.int64)
                    for i, x, y in zip(at.tolist(), m.astype(np.uint8), band):
                        sig[i], bands[i] = x.tobytes(), y
                none = count == 0
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(count, pa.int64()), pa.array(lo.astype(np.int64), mask=none),
                     pa.array(hi.astype(np.int64), mask=none), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "n_shingles", "set_lo", "set_hi", "signature", "bands"])

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, n_shingles long, set_lo long, set_hi long, signature binary, bands array<long>")


def in_blocks(rows: DataFrame, key: str, block: int = BLOCK) -> DataFrame:
    """Rows of each ``key`` that has two or more, with ``task``, the name of a
    group of at most two blocks, and ``side``, the row's block in it.

    A key of ``n`` rows has ceil(n / block) blocks; a row goes to the pairs of
    its block with every block of the key."""
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    some = rows.withColumn("n", n).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    side = F.pmod(F.xxhash64("class", F.lit(9)), F.col("blocks")).cast("int")
    return (some.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("task", F.xxhash64(key, F.least("side", "other"), F.greatest("side", "other"))).drop("n", "blocks", "other"))


def groups(batches, column: str = "task"):
    """Record batches of whole groups, from batches sorted by ``column``."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        keys = held.column(column).to_numpy()
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        if last:
            yield held.slice(0, last).combine_chunks().to_batches()[0]
            held = held.slice(last)
    if held is not None and held.num_rows:
        yield held.combine_chunks().to_batches()[0]


class Forest:
    """Union-find over row numbers; ``add`` tells whether the edge was needed."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def add(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _edges(batch: pa.RecordBatch, near) -> pa.RecordBatch:
    """The edges of a spanning forest of ``near`` pairs of each group.

    ``near(lo, hi)`` yields (row, rows of the group that link with it)."""
    ids, side = batch.column("class").to_numpy(), batch.column("side").to_numpy()
    keys = batch.column("task").to_numpy()
    cut = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    forest, a, b = Forest(len(ids)), [], []
    for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(ids)]):
        if hi - lo < 2:
            continue
        across = side[lo] != side[lo:hi]
        across = across.any()  # two blocks meet: each alone has a task of its own
        for x, found in near(lo, hi):
            for y in found.tolist():
                if (not across or side[x] != side[y]) and ids[x] != ids[y] and forest.add(x, y):
                    a.append(ids[x])
                    b.append(ids[y])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def similar_signatures(rows: DataFrame, percent: int) -> DataFrame:
    """Spanning edges (a, b) of each task's rows whose signatures agree."""
    p, n = percent / 100, BANDS * ROWS
    least = int(n * p - 5.5 * (n * p * (1 - p)) ** 0.5)

    def run(batches):
        for batch in groups(batches):
            raw = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint8).reshape(-1, n)

            def near(lo, hi):
                for x in range(lo, hi - 1):
                    yield x, x + 1 + np.flatnonzero((raw[x + 1:hi] == raw[x]).sum(1) >= least)
            yield _edges(batch, near)

    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def linked_texts(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Spanning edges (a, b) of each task's texts with 100 * intersection >=
    percent * union of their full sets."""
    def run(batches):
        for batch in groups(batches):
            doc, s = sliced_sets(batch, size)
            count = np.bincount(doc, minlength=batch.num_rows)
            start = np.concatenate([[0], np.cumsum(count)])

            def near(lo, hi):
                mine = s[start[lo]:start[hi]]
                owner = doc[start[lo]:start[hi]] - lo
                order = np.argsort(mine, kind="stable")
                owner, sorted_ = owner[order], mine[order]
                for x in range(lo, hi - 1):
                    own = s[start[x]:start[x + 1]]
                    a, b = np.searchsorted(sorted_, own), np.searchsorted(sorted_, own, side="right")
                    take = np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange(int((b - a).sum()))
                    both = np.bincount(owner[take], minlength=hi - lo)
                    union = count[x] + count[lo:hi] - both
                    hit = lo + np.flatnonzero(100 * both >= percent * union)
                    yield x, hit[hit > x]
            yield _edges(batch, near)

    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def _grouped(docs: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """doc_id, text_hash, n_shingles, group (null without a set) and
    component_id of every row."""
    all_rows = scratch.save(sketch(docs, size).withColumn("row", F.monotonically_increasing_id()), "sketch")
    named = all_rows.where("n_shingles > 0 and doc_id is not null")
    key = ["set_lo", "set_hi", "n_shingles"]
    classes = scratch.save(named.groupBy(*key).agg(F.min("row").alias("class"), F.min("doc_id").alias("rep")), "classes")

    one = scratch.save(named.join(classes.select("class"), named["row"] == F.col("class"), "left_semi")
                       .select(F.col("row").alias("class"), "doc_id", "text_hash", "signature", "bands"), "reps")
    tasks = in_blocks(one.select("class", F.explode("bands").alias("bucket")), "bucket", 4 * BLOCK).select("class", "task", "side")
    pairs = scratch.save(similar_signatures(tasks.join(one.select("class", "signature"), "class"), percent), "similar")
    group = components(pairs, scratch)
    group = group.union(group.select("component", "component").distinct()).toDF("class", "comp")
    group = scratch.save(group.join(one.select("class", "doc_id", "text_hash"), "class"), "groups")
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(CELLS))
    cells = group.select(cell.alias("cell")).distinct()
    # a text is looked up by its id and hash: rows of one id may hold several
    texts = (docs.withColumn("cell", cell).join(F.broadcast(cells), "cell", "left_semi")  # at most CELLS rows
             .select("doc_id", F.xxhash64("text").alias("text_hash"), "text").dropDuplicates(["doc_id", "text_hash"]))
    tasks = in_blocks(group, "comp").select("class", "doc_id", "text_hash", "task", "side")
    links = scratch.save(linked_texts(tasks.join(texts, ["doc_id", "text_hash"]).select("class", "task", "side", "text"), size, percent), "links")

    comp = components(links, scratch)
    comp = scratch.save(comp.union(comp.select("component", "component").distinct()).toDF("node", "root"), "linked")
    # the smallest doc_id of each group of several classes
    found = classes.join(comp, classes["class"] == comp["node"], "left")
    low = found.where("root is not null").groupBy("root").agg(F.min("rep").alias("low")).select(F.col("root").alias("linked"), "low")
    found = found.join(low, found["root"] == low["linked"], "left").select(
        *key, F.coalesce("root", "class").alias("group"), F.coalesce("low", "rep").alias("component_id"))
    return (all_rows.join(found, key, "left").select("doc_id", "text_hash", "n_shingles", "group", F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def near_duplicates(docs: DataFrame, size: int, percent: int, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    scratch = scratch or Scratch(docs.sparkSession, "minhash")
    out = _grouped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs)), size, percent, scratch)
    return (out.select("doc_id", "n_shingles", "component_id")
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def distinct_documents(docs: DataFrame, size: int = 5, percent: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """One row of ``docs`` for each group, with all columns: of the rows that
    carry the group's smallest doc_id the one of the smallest text hash."""
    scratch = scratch or Scratch(docs.sparkSession, "minhash")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs))
    out = _grouped(narrow, size, percent, scratch).where("doc_id = component_id")
    # texts without words are no group: each of them stays
    alone = F.when(F.col("group").isNull(), F.col("text_hash"))
    kept = out.groupBy("doc_id", "group", alone.alias("alone")).agg(F.min("text_hash").alias("kept_hash")).select(
        F.col("doc_id").alias("kept_id"), "kept_hash")
    rows = docs.select(whole(docs), F.col("doc_id").cast("long").alias("id"), F.xxhash64(text_column(docs)).alias("hash"))
    stay = rows.join(kept, (F.col("id") == F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")), "left_semi")
    stay = stay.dropDuplicates(["id", "hash"]).union(rows.where("id is null"))
    return unpacked(stay.select("whole"), docs.columns, {})


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 85)
