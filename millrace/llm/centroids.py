"""Centroid clustering of vectors in exact integers, by blocked matrix products.

Components become integers floor(64 * x). In each round every vector goes to its
nearest centroid, and each centroid to the floored mean of its vectors. Distances
come from |x|^2 - 2 x.c + |c|^2 with one float64 matrix product a block. That is exact
while d * (max|x| + max|c|)^2 stays below 2^53, as every partial sum is then a whole
number that a double holds; rows and centroids beyond that bound go through 64-bit
integers, and those beyond these through Python's. Ties go to the smaller number.

A round is one pass over the vectors: tasks add up counts, sums and distances of
each cluster and give one record a partition, and RDD.treeAggregate combines these in
Python integers. So the driver gets k sums, however many vectors there are. Nothing is
written: a lost executor's partitions are read and assigned again. The frame is read
once a round; cut an expensive one first.

Defined results: vectors with another number of components, or with a null or
non-finite one, are left out; a null vec_id counts as the text "null" where first
centroids are chosen; vectors with one vec_id are taken by their components then;
with fewer vectors than centroids there are as many centroids as vectors; a centroid
without vectors stays; distances beyond a long are null, though compared exactly;
other columns aren't read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

DIMENSIONS, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
#: Vectors of a block: its product with the centroids stays in a processor's cache.
BLOCK = 4096
DOUBLE, LONG = 1 << 53, 1 << 63

Whole = list[list[int]]
#: Of each cluster: how many vectors, their sums by component, their summed distances.
Sums = tuple[list[int], np.ndarray, list[int]]


def quantised(x: np.ndarray) -> np.ndarray:
    """floor(64 * x) as float64, in which it is exact: the factor is a power of two. Beyond a double's range it is infinite."""
    with np.errstate(over="ignore"):
        return np.floor(SCALE * x.astype(np.float64))


def whole(x: np.ndarray) -> list[int]:
    """One vector's integers."""
    return [int(q) if np.isfinite(q) else SCALE * int(v) for q, v in zip(quantised(x), x, strict=True)]


def _integers(rows: Whole, centroids: Whole, bound: int) -> np.ndarray:
    """Squared distances of rows to centroids in integers of 64 bits, or of any size."""
    kind = np.int64 if bound < LONG else object
    c = np.array(centroids, dtype=kind).reshape(len(centroids), -1)
    out = [((np.array(r, dtype=kind) - c) ** 2).sum(axis=1) for r in rows]
    return np.array(out, dtype=object).reshape(len(rows), len(c))


def nearest(x: np.ndarray, centroids: Whole) -> tuple[np.ndarray, list[int]]:
    """The nearest centroid of each row of a block, and the squared distance to it."""
    d, q = x.shape[1], quantised(x)
    largest = np.abs(q).max(axis=1)
    reach = [max(map(abs, c)) for c in centroids]
    bound = math.isqrt(DOUBLE // d)  # of max|x| + max|c|
    near = [j for j, r in enumerate(reach) if 2 * r < bound]
    plain = largest < bound - max(reach[j] for j in near) if near else np.zeros(len(x), dtype=bool)
    label, distance = np.zeros(len(x), dtype=np.int32), [0] * len(x)
    rows = np.flatnonzero(plain)
    far = [j for j in range(len(centroids)) if j not in set(near)]
    if len(rows):
        c = np.array([centroids[j] for j in near], dtype=np.float64)
        part = q[rows]
        squares = (part * part).sum(axis=1)[:, None] - 2.0 * (part @ c.T) + (c * c).sum(axis=1)
        at = squares.argmin(axis=1)
        label[rows] = np.array(near)[at]
        least = squares[np.arange(len(rows)), at].astype(np.int64)
        # a centroid farther off in one component than all the least distance can't win
        far_now = [j for j in far if (reach[j] - int(largest[rows].max())) ** 2 <= int(least.max())]
        for r, s in zip(rows.tolist(), least.tolist(), strict=True):
            distance[r] = s
            if far_now:
                others = _integers([whole(x[r])], [centroids[j] for j in far_now], d * (int(largest[r]) + max(reach[j] for j in far_now)) ** 2)[0]
                distance[r], label[r] = min((s, int(label[r])), *((int(v), j) for v, j in zip(others, far_now, strict=True)))
    for r in np.flatnonzero(~plain).tolist():
        own = whole(x[r])
        all_ = _integers([own], centroids, d * (max(map(abs, own)) + max(reach)) ** 2)[0]
        distance[r], label[r] = min((int(v), j) for j, v in enumerate(all_))
    return label, distance


def _sums(x: np.ndarray, label: np.ndarray, distance: list[int], k: int) -> Sums:
    """What a block adds to its clusters."""
    q = quantised(x)
    large = np.abs(q).max(axis=1) >= LONG >> 20  # a block has fewer than 2^20 rows
    counts, sums, inertia = np.bincount(label, minlength=k).tolist(), np.zeros((k, x.shape[1]), dtype=object), [0] * k
    for j in range(k):
        of = label == j
        sums[j] = q[of & ~large].astype(np.int64).sum(axis=0).astype(object)
        for r in np.flatnonzero(of & large):
            sums[j] = sums[j] + np.array(whole(x[r]), dtype=object)
    for j, s in zip(label.tolist(), distance, strict=True):
        inertia[j] += s
    return counts, sums, inertia


def _add(a: Sums, b: Sums) -> Sums:
    return [x + y for x, y in zip(a[0], b[0], strict=True)], a[1] + b[1], [x + y for x, y in zip(a[2], b[2], strict=True)]


def _blocks(batch: pa.RecordBatch, d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, len(batch), BLOCK):
        part = batch.slice(at, BLOCK)
        yield part, part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _round(kept: DataFrame, centroids: Whole, d: int) -> Sums:
    """Counts, sums and distances of the clusters when every vector goes to its nearest centroid."""
    k = len(centroids)
    none = ([0] * k, np.zeros((k, d), dtype=object), [0] * k)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = none
        for batch in batches:
            for _, x in _blocks(batch, d):
                total = _add(total, _sums(x, *nearest(x, centroids), k))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], names=["sums"])

    return kept.select("vector").mapInArrow(added, "sums binary").rdd.map(lambda row: pickle.loads(row["sums"])).treeAggregate(none, _add, _add)


def kept_vectors(vectors: DataFrame, id_: str, vector: str, dimensions: int) -> DataFrame:
    """(id, vector) of the vectors that take part."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where((F.size(x) == dimensions) & finite).select(F.col(id_).alias("id"), x.alias("vector"))


def first_centroids(kept: DataFrame, k: int) -> Whole:
    """The k vectors with the smallest SHA-256 of `1:<id>`, in order of it."""
    hashed = kept.withColumn("hash", F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256))
    return [whole(np.array(r["vector"], dtype=np.float64)) for r in hashed.orderBy("hash", "vector").limit(k).collect()]


def fit(kept: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> Whole:
    """The centroids after some rounds."""
    centroids = first_centroids(kept, k)
    for _ in range(rounds if centroids else 0):
        counts, sums, _ = _round(kept, centroids, len(centroids[0]))
        centroids = [[int(s) // n for s in row] if n else old for n, row, old in zip(counts, sums, centroids, strict=True)]
    return centroids


def cluster(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS, k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """(id_, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part."""
    kept = kept_vectors(vectors, id_, vector, dimensions)
    centroids = fit(kept, k, rounds)
    inertia = _round(kept, centroids, dimensions)[2] if centroids else []
    long = lambda v: v if v < LONG else None
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    by_cluster, all_ = pa.array([long(v) for v in inertia], pa.int64()), long(sum(inertia))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _blocks(batch, dimensions):
                label, distance = nearest(x, centroids)
                of = pa.array(label)
                columns = [part.column("id"), of, pa.array([long(v) for v in distance], pa.int64()), by_cluster.take(of), pa.array([all_] * len(of), pa.int64()), pa.array(names, pa.string()).take(of)]
                yield pa.RecordBatch.from_arrays(columns, names=[id_, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    made = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    return kept.mapInArrow(assigned, T.StructType([T.StructField(id_, kept.schema["id"].dataType), *T.StructType.fromDDL(made).fields]))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings."""
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


_ROUND = """, near{r} AS (
  SELECT v, arg_min(c, d * 1000 + c) AS cluster, min(d) AS distance FROM (
    SELECT x.v, m.c, sum((x.x - m.x) * (x.x - m.x)) AS d FROM parts x JOIN mean{r} m ON x.i = m.i GROUP BY x.v, m.c) GROUP BY v
)"""
_MEANS = """, mean{n} AS (
  SELECT m.c, m.i, coalesce(f.x, m.x) AS x FROM mean{r} m LEFT JOIN (
    SELECT n.cluster, p.i, (sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) // count(*) AS x FROM near{r} n JOIN parts p ON p.v = n.v GROUP BY n.cluster, p.i) f ON f.cluster = m.c AND f.i = m.i
)"""
SQL = (
    """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, 'null')), embedding) AS v, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT v, unnest(range(1, 65)) AS i, floor(64 * unnest(embedding)::DOUBLE)::HUGEINT AS x FROM kept
), mean0 AS (
  SELECT v - 1 AS c, i, x FROM parts WHERE v <= 16
)"""
    + "".join(_ROUND.format(r=r) + (_MEANS.format(r=r, n=r + 1) if r < ROUNDS else "") for r in range(ROUNDS + 1))
    + f"""
, named AS (
  SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM mean{ROUNDS} GROUP BY c
)
SELECT vec_id, n.cluster::INT AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY n.cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM near{ROUNDS} n JOIN kept USING (v) JOIN named ON named.c = n.cluster
"""
)
