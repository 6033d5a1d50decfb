"""Clustering of embeddings around centroids by the threshold algorithm
(operator 13).

Vectors are scaled to integers, so every sum, mean and distance is exact and
does not depend on how the rows are dealt to tasks.

* Nearest centroid (``nearest``): each dimension has the centroids sorted by
  their value there.  A vector walks each list outward from its own value, one
  centroid a step, and computes the whole distance of a centroid when it first
  meets it.  A centroid that was met nowhere is at least as far, in every
  dimension, as the frontier; once the sum of squared frontier distances is
  strictly greater than the best distance none of them can win or tie.  A vector
  that has met all centroids stops too.
* A round broadcasts the centroids (``k`` x ``dim`` numbers, whatever the rows)
  and adds up each task's vectors by centroid; Spark sums those partial sums,
  of which ``k`` x ``dim`` rows reach the driver for the new means.  No group of
  vectors meets in one task, however large its cluster.

Defined results: vectors that are null, of another length, or that hold null or
non-finite components are left out (no row).  Repeated rows are vectors of their
own.  The starting centroids are ordered by (hash, vec_id, components); a null
vec_id is hashed as an empty number.  Scaled components are held within +-2^26,
so that a distance fits a long; an inertia beyond a long is the greatest long.  Fewer vectors than ``k``
give as many centroids; none, or an empty table, give no rows.  Other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.scratch import Scratch

#: Scaled components lie within +-LIMIT.
LIMIT = 1 << 26
#: Vectors that walk together: bounds the memory of a task.
BLOCK = 512
_LONG = (1 << 63) - 1


class SortedCentroids:
    """Per dimension, the centroids in ascending order of their value."""

    def __init__(self, centroids: np.ndarray):
        self.points = centroids                                  # (k, dim)
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(centroid, squared distance) of each row, the smaller number on
        ties; and the steps that the last row to stop has walked."""
        n, dim = x.shape
        k = len(self.points)
        far = np.iinfo(np.int64).max
        best, which = np.full(n, far), np.full(n, k)
        right = np.stack([np.searchsorted(self.values[:, d], x[:, d]) for d in range(dim)], axis=1) if n else np.zeros((0, dim), int)
        left = right - 1
        met = np.zeros((n, k), bool)
        at, dims, steps = np.arange(n), np.arange(dim), 0        # rows that still walk
        while len(at) and steps < k:
            steps += 1
            gap_l = np.where(left >= 0, x[at] - self.values[np.maximum(left, 0), dims], far)
            gap_r = np.where(right < k, self.values[np.minimum(right, k - 1), dims] - x[at], far)
            go_left = gap_l <= gap_r
            spot = np.where(go_left, left, right)                # k - steps + 1 centroids are left in every list
            frontier = np.where(go_left, gap_l, gap_r)
            seen = np.zeros((len(at), k), bool)
            seen[np.arange(len(at))[:, None], self.order[spot, dims]] = True
            row, new = np.nonzero(seen & ~met[at])
            met[at[row], new] = True
            dist = ((x[at[row]] - self.points[new]) ** 2).sum(axis=1)
            # the best new one of each row: nearest first, then the smaller number
            first = np.lexsort((new, dist, row))
            row, new, dist = row[first], new[first], dist[first]
            head = np.ones(len(row), bool)
            head[1:] = row[1:] != row[:-1]
            row, new, dist = at[row[head]], new[head], dist[head]
            wins = (dist < best[row]) | ((dist == best[row]) & (new < which[row]))
            best[row[wins]], which[row[wins]] = dist[wins], new[wins]
            left, right = left - go_left, right + ~go_left
            walks = ((frontier ** 2).sum(axis=1) <= best[at]) & ~met[at].all(axis=1)
            at, left, right = at[walks], left[walks], right[walks]
        return which, best, steps


def scaled_vectors(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """vec_id and the integer components of the vectors that count."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    fine = (F.size("e") == dim) & F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    held = F.transform("e", lambda v: F.least(F.greatest(F.floor(v * F.lit(float(scale))), F.lit(-LIMIT)), F.lit(LIMIT)).cast("int"))
    return rows.where(F.coalesce(fine, F.lit(False))).select("vec_id", held.alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _blocks(batches, dim: int):
    for batch in batches:
        x = _matrix(batch.column("x"), dim)
        for i in range(0, len(x), BLOCK):
            yield batch.slice(i, BLOCK), x[i:i + BLOCK].astype(np.int64)


def _partial_sums(model, dim: int):
    def run(batches):
        k = len(model.value.points)
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, x in _blocks(batches, dim):
            which, _, _ = model.value.nearest(x)
            np.add.at(sums, which, x)
            counts += np.bincount(which, minlength=k)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(some, dim).astype(np.int32)), pa.array(np.tile(np.arange(dim, dtype=np.int32), len(some))),
             pa.array(sums[some].ravel()), pa.array(np.repeat(counts[some], dim))], ["cluster", "d", "total", "n"])
    return run


def _assign(model, dim: int):
    def run(batches):
        for part, x in _blocks(batches, dim):
            which, dist, _ = model.value.nearest(x)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(which.astype(np.int32)), pa.array(dist)],
                                             ["vec_id", "cluster", "distance"])
    return run


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2,
            scratch: Scratch | None = None) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid (its
    final components) for every vector that counts."""
    scratch = scratch or Scratch(vectors.sparkSession, "centroids")
    spark = scratch.spark
    rows = scratch.save(scaled_vectors(vectors, dim, scale), "scaled")
    start = (rows.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256))
             .orderBy("h", "vec_id", "x").limit(k).collect())
    points = np.array([r.x for r in start], np.int64).reshape(-1, dim)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not len(points):
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(SortedCentroids(points))
        sums = (rows.mapInArrow(_partial_sums(model, dim), "cluster int, d int, total long, n long")
                .groupBy("cluster", "d").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())
        points = points.copy()
        for r in sums:  # k * dim rows
            points[r.cluster, r.d] = r.total // r.n
    model = spark.sparkContext.broadcast(SortedCentroids(points))
    out = scratch.save(rows.mapInArrow(_assign(model, dim), "vec_id long, cluster int, distance long"), "assigned")
    inertia = {r.cluster: r.s for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    final = spark.createDataFrame(
        [(c, min(int(s), _LONG), min(int(sum(inertia.values())), _LONG), [int(v) for v in points[c]]) for c, s in inertia.items()],
        T.StructType.fromDDL("c int, cluster_inertia long, inertia long, centroid array<long>"))
    return (out.join(F.broadcast(final), out["cluster"] == final["c"])
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"))


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    sha = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", sha.alias("centroid_sha256"))


def _oracle(k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2) -> str:
    """All distances to all centroids, round by round."""
    near = """a{r} AS MATERIALIZED (
  SELECT vec_id, c, dist FROM (
    SELECT v.vec_id, m.c, sum((v.x - m.x) * (v.x - m.x))::BIGINT AS dist FROM v JOIN c{r} m ON m.d = v.d GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, c) = 1
)"""
    move = """c{n} AS MATERIALIZED (
  SELECT m.c, m.d, coalesce(s.x, m.x) AS x FROM c{r} m LEFT JOIN (
    SELECT a.c, v.d, (CASE WHEN sum(v.x) < 0 THEN -((-sum(v.x) + count(*) - 1) // count(*)) ELSE sum(v.x) // count(*) END)::BIGINT AS x
    FROM a{r} a JOIN v ON v.vec_id = a.vec_id GROUP BY ALL) s ON s.c = m.c AND s.d = m.d
)"""
    steps = []
    for r in range(rounds):
        steps += [near.format(r=r), move.format(r=r, n=r + 1)]
    return f"""WITH kept AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) = {dim} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), v AS MATERIALIZED (
  SELECT vec_id, d, floor({scale} * e[d])::BIGINT AS x FROM kept, unnest(range(1, {dim + 1})) u(d)
), seeds AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM kept
  QUALIFY c < {k}
), c0 AS MATERIALIZED (
  SELECT s.c, v.d, v.x FROM seeds s JOIN v ON v.vec_id = s.vec_id
), {', '.join(steps)}, {near.format(r=rounds)}, sha AS (
  SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c
), inertia AS (
  SELECT c, sum(dist)::BIGINT AS s FROM a{rounds} GROUP BY c
)
SELECT a.vec_id, a.c::INTEGER AS cluster, a.dist AS distance, i.s AS cluster_inertia,
       (SELECT sum(s) FROM inertia)::BIGINT AS inertia, centroid_sha256
FROM a{rounds} a JOIN inertia i ON i.c = a.c JOIN sha ON sha.c = a.c
"""


ORACLE = _oracle()
