"""Embedding near-duplicates by a random-projection tree forest (operator 2).

1. Equal vectors form a class; its smallest vec_id stands for it with the
   class size as weight.
2. The forest is fitted on a bounded sample (``SAMPLE`` classes, by hash of
   vec_id): each tree halves space again and again along random directions,
   at a random quantile of the node's sample.  Below the depth that the sample
   supports, nodes split at the level's centre.  The model holds at most
   TREES * 2 * SAMPLE / FEW thresholds, whatever the data's size.
3. Every class goes down all trees.  Near a threshold it goes down both sides
   (spill); the margin is the spread that a pair at the cosine threshold has
   along a random direction.  As many trees are used as a pair at the threshold
   needs to share a leaf but for a chance of ``MISSED``, reckoned from the share
   of vectors that spill on each level of the first tree (``FEWEST`` to
   ``TREES``; one where a single leaf holds all).
4. Leaves are compared in blocks: a leaf larger than ``BLOCK`` is split by
   hash, and each pair of its blocks is a group of its own, so no task holds
   a whole leaf however many vectors crowd into it.
5. A pair of a leaf counts only in the first leaf that its two vectors share,
   so links are counted once without a list of pairs: a group gives each
   vector its number of links and a spanning forest of them.
6. Components by alternating large-star and small-star.

Null, empty or zero vectors, and those with null or non-finite components,
link with nothing.  Shorter vectors count as padded with zeros.  Rows of equal
vec_id are separate vectors that share a component.  A null vec_id links with
nothing.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.scratch import Scratch

TREES, FEWEST = 8, 4
MISSED = 1e-3
LEAF, BLOCK = 768, 1536
SAMPLE, FEW = 20_000, 8


def trees_needed(spilled: list[float]) -> int:
    """How many trees a pair at the threshold needs, given the share of vectors
    within the margin of a threshold on each level.

    A pair parts where its projections lie beyond both margins.  Their distance
    is normal with a deviation of the two margins' width, so of the pairs around
    a threshold E[max(|z| - 1, 0)] = 1/6 parts for each one that spills."""
    if not spilled:
        return 1
    together = float(np.prod([1 - s / 6 for s in spilled]))
    return int(np.clip(np.ceil(np.log(MISSED) / np.log1p(-min(together, 0.9999))), FEWEST, TREES))


class Forest:
    """Directions of each (tree, level), thresholds of the sampled nodes."""

    def __init__(self, sample: np.ndarray, rows: int, cosine: float, seed: int = 17):
        rng = np.random.default_rng(seed)
        d = sample.shape[1]
        self.depth = max(0, int(np.ceil(np.log2(max(rows, 1) / LEAF))))
        self.across = rng.normal(size=(TREES, self.depth, d))
        self.across /= np.linalg.norm(self.across, axis=2, keepdims=True)
        #: half the deviation of a pair at the threshold along a direction
        self.margin = 0.5 * float(np.sqrt(2 - 2 * cosine) / np.sqrt(d))
        self.cuts: list[dict[int, float]] = []
        self.trees, spilled = TREES, []
        for t in range(TREES):
            if t == self.trees:
                break
            cuts, nodes = {}, {1: np.arange(len(sample))}
            for level in range(self.depth):
                below = {}
                near = total = 0
                for node, rows_ in nodes.items():
                    if len(rows_) < FEW:
                        continue
                    p = sample[rows_] @ self.across[t, level]
                    cuts[node] = float(np.quantile(p, rng.uniform(0.4, 0.6)))
                    below[2 * node], below[2 * node + 1] = rows_[p <= cuts[node]], rows_[p > cuts[node]]
                    near, total = near + int((np.abs(p - cuts[node]) <= self.margin).sum()), total + len(p)
                nodes = below
                # below the sampled levels, as many spill as on the last of them
                spilled.append(near / total if total else spilled[-1] if spilled else 1.0)
            self.cuts.append(cuts)
            if t == 0:
                self.trees = trees_needed(spilled)

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf code) of every leaf that each row of ``x`` reaches."""
        rows, codes = [], []
        for t in range(self.trees):
            at, node = np.arange(len(x)), np.ones(len(x), np.int64)
            for level in range(self.depth):
                p = x @ self.across[t, level]
                uniq, back = np.unique(node, return_inverse=True)
                cut = np.array([self.cuts[t].get(int(u), 0.0) for u in uniq])[back]
                left, right = p[at] <= cut + self.margin, p[at] > cut - self.margin
                at = np.concatenate([at[left], at[right]])
                node = np.concatenate([2 * node[left], 2 * node[right] + 1])
            rows.append(at)
            codes.append((np.int64(t) << 50) + node)
        return np.concatenate(rows), np.concatenate(codes)


def unit(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of length one, padded with zeros to ``dim``."""
    lens = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(vectors), dim))
    row = np.repeat(np.arange(len(lens)), lens)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    out /= np.abs(out).max(axis=1, keepdims=True)  # no overflow in the norm
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def roots(near: np.ndarray) -> np.ndarray:
    """The smallest row of each row's component in a symmetric matrix."""
    label = np.arange(len(near))
    src, dst = np.nonzero(near)
    while len(src):
        low = label.copy()
        np.minimum.at(low, src, label[dst])
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    return label


def compare(dim: int, cosine: float):
    """Links of one block pair of a leaf: (a, links) and spanning (a, b)."""
    def run(key, table):
        code = key[0].as_py()
        table = table.combine_chunks().sort_by("vec_id")
        ids, side = (table.column(c).to_numpy() for c in ("vec_id", "side"))
        weight = table.column("weight").to_numpy()
        x = unit(table.column("embedding").combine_chunks(), dim)
        met = table.column("codes").combine_chunks()
        owner = np.repeat(np.arange(len(ids)), met.value_lengths().to_numpy(zero_copy_only=False))
        flat = met.flatten().to_numpy(zero_copy_only=False)
        early = flat < code
        uniq, back = np.unique(flat[early], return_inverse=True)
        member = np.zeros((len(ids), len(uniq)), np.float32)
        member[owner[early], back] = 1
        near = x @ x.T >= cosine
        np.fill_diagonal(near, False)
        if side.min() != side.max():  # two different blocks: only pairs across
            near &= side[:, None] != side[None, :]
        near &= member @ member.T == 0
        links = near @ weight
        root = roots(near)
        far = np.flatnonzero(root != np.arange(len(ids)))
        some = np.flatnonzero(links)
        return pa.table({"a": pa.array(np.concatenate([ids[some], ids[far]])),
                         "b": pa.array(np.concatenate([ids[some], ids[root[far]]])),
                         "links": pa.array(np.concatenate([links[some], np.zeros(len(far), np.int64)]).astype(np.int64))})
    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, scratch: Scratch | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``."""
    scratch = scratch or Scratch(vectors.sparkSession, "forest")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
            & F.coalesce(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists("embedding", lambda v: v != 0), F.lit(False)))
    rows = scratch.save(rows.withColumn("embedding", F.when(fine, F.col("embedding")))
                        .withColumn("hash", F.when(fine, F.xxhash64("embedding"))), "rows")
    classes = scratch.save(rows.where("embedding is not null").groupBy("hash", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
        .select(F.col("rep").alias("vec_id"), "weight", "embedding", "hash"), "classes")
    n, dim = classes.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    links = comp = None
    if n > 1:
        sample = classes.select("embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
        forest = Forest(unit(sample.column("embedding").combine_chunks(), dim), n, cosine)
        model = scratch.spark.sparkContext.broadcast(forest)  # bounded by SAMPLE

        def route(batches):
            for batch in batches:
                at, code = model.value.leaves(unit(batch.column("embedding"), dim))
                order = np.lexsort((code, at))
                ends = np.searchsorted(at[order], np.arange(batch.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(code[order]))
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("vec_id", "weight", "embedding")] + [lists],
                                                 ["vec_id", "weight", "embedding", "codes"])

        routed = scratch.save(classes.select("vec_id", "weight", "embedding").mapInArrow(
            route, "vec_id long, weight long, embedding array<double>, codes array<long>"), "routed")
        spots = routed.withColumn("code", F.explode("codes"))
        size = (spots.groupBy("code").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
                .select("code", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")))
        mine = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("blocks")).cast("int")
        pair = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        groups = (spots.join(size, "code").withColumn("side", mine).withColumn("other", pair)
                  .withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other")))
        met = scratch.save(groups.groupBy("code", "low", "high").applyInArrow(
            compare(dim, cosine), "a long, b long, links long"), "met")
        links = met.where("a = b").groupBy("a").agg(F.sum("links").alias("links"))
        edges = met.where("a != b").select("a", "b")
        comp = components(edges, scratch)
    reps = classes.select(F.col("hash").alias("h"), F.col("embedding").alias("e"), F.col("vec_id").alias("rep"), "weight")
    out = rows.join(reps, (rows["hash"] == reps["h"]) & (rows["embedding"] == reps["e"]), "left").select("vec_id", "rep", "weight")
    if links is not None:
        out = (out.join(links, out["rep"] == links["a"], "left").join(comp, out["rep"] == comp["node"], "left"))
    else:
        out = out.withColumn("links", F.lit(None)).withColumn("component", F.lit(None))
    return (out.select("vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).cast("long").alias("n_links"),
                       F.coalesce("component", "rep", "vec_id").cast("long").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def op2_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
