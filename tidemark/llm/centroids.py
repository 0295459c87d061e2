"""Centroid clustering whose nearest centroids come from the threshold algorithm.

Each dimension keeps its centroids sorted by value. From a vector's own value the list is walked
outward, nearest entries first, in all dimensions side by side; a centroid met for the first time
gets its exact distance. What no list has shown yet is in every dimension at least as far as the
entry read last, so the walk of a vector ends when the sum of these squared frontier distances is
strictly above its best exact distance (an equal one could belong to a smaller number).

Components are integers, ``floor(scale * x)``, and all sums and distances are exact. Vectors
with a component beyond 2^24 are handled with Python's integers, and sums over rows are kept as
30-bit limbs, so no size of a component overflows; a distance or inertia that no long holds is null.

Vectors that are null, have another number of components, or a component that is null or not
finite take no part. Repeated rows each count, also as first centroids. A vector without an id
is clustered, but never a first centroid. Fewer vectors than centroids give fewer centroids, an
empty table an empty result, and with no first centroid at all everything but the ids is null.
Ties go to the smaller number; columns besides the two are ignored.

Per round one pass over the vectors adds up, per task and with no shuffle of vectors, the sums of
each cluster; the driver holds the centroids and at most one row per cluster, dimension and limb.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import durable

BLOCK_ROWS = 4096
SMALL = 1 << 24
LIMB = 30
LONG = 1 << 63


def usable(df: DataFrame, dims: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Id and vector of the rows that have exactly ``dims`` finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.select(key, vector).where((F.size(vector) == dims) & finite)


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of finite doubles; Python's integers where one is beyond 2^24."""
    if not len(values) or np.abs(values).max() < SMALL / scale:
        return np.floor(values * scale).astype(np.int64)
    ratios = [x.as_integer_ratio() for x in values.ravel().tolist()]
    return np.array([a * scale // b for a, b in ratios] + [None], object)[:-1].reshape(values.shape)


def nearest(block: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, and its squared distance."""
    rows, dims = block.shape
    if block.dtype == object or centroids.dtype == object:
        block, centroids = block.astype(object), centroids.astype(object)
    k, kind = len(centroids), block.dtype
    order = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, order, axis=0)
    axes = np.arange(dims)
    above = np.stack([np.searchsorted(values[:, d], block[:, d], side="left") for d in range(dims)], axis=1)
    below = above - 1
    seen = np.zeros((rows, k), bool)
    best, who = np.zeros(rows, kind), np.full(rows, -1)
    active = np.arange(rows)
    while len(active):
        v, lo, hi = block[active], below[active], above[active]
        down = np.where(lo >= 0, v - values[np.maximum(lo, 0), axes], 0)
        up = np.where(hi < k, values[np.minimum(hi, k - 1), axes] - v, 0)
        go_down = (lo >= 0) & ((hi >= k) | (down <= up))
        frontier = np.where(go_down, down, up)
        read = order[np.where(go_down, lo, np.minimum(hi, k - 1)), axes]
        below[active], above[active] = lo - go_down, hi + ~go_down
        met = np.zeros((len(active), k), bool)
        np.put_along_axis(met, read, True, axis=1)
        met &= ~seen[active]
        seen[active] |= met
        for c in np.flatnonzero(met.any(axis=0)):
            at = active[met[:, c]]
            away = ((block[at] - centroids[c]) ** 2).sum(axis=1)
            nearer = (who[at] < 0) | (away < best[at]) | ((away == best[at]) & (c < who[at]))
            best[at[nearer]], who[at[nearer]] = away[nearer], c
        left = (frontier ** 2).sum(axis=1) <= best[active]
        active = active[left.astype(bool) & ~seen[active].all(axis=1)]
    return who, best


def _blocks(batches: Iterator[pa.RecordBatch], vector: str, dims: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            flat = part.column(vector).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield part, integers(flat.reshape(-1, dims), scale)


def first_centroids(vectors: DataFrame, k: int, scale: int, seed: str, key: str, vector: str) -> np.ndarray:
    """The vectors whose hashed ids come first; equal ids are told apart by their vectors."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    rows = vectors.where(F.col(key).isNotNull()).orderBy(digest, vector).limit(k).select(vector).collect()
    return integers(np.array([r[0] for r in rows], np.float64), scale)


def _sums(vectors: DataFrame, centroids: np.ndarray, scale: int, vector: str) -> dict[tuple[int, int], int]:
    """Sum of each cluster and dimension, and at dimension -1 the number of vectors."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((k, dims + 1), object)
        for _, block in _blocks(batches, vector, dims, scale):
            who, _ = nearest(block, centroids)
            for c in np.unique(who):
                mine = block[who == c]
                totals[c, :dims] += mine.sum(axis=0).astype(object)
                totals[c, dims] += len(mine)
        found = []
        for (c, d), total in np.ndenumerate(totals):
            sign, rest, limb = (-1 if total < 0 else 1), abs(int(total)), 0
            while rest:
                found.append((int(c), -1 if d == dims else int(d), limb, sign * (rest & ((1 << LIMB) - 1))))
                rest, limb = rest >> LIMB, limb + 1
        if found:
            yield pa.RecordBatch.from_pydict(dict(zip(("cluster", "dim", "limb", "total"), map(list, zip(*found)))),
                                             schema=arrow)

    arrow = pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("limb", pa.int32()), ("total", pa.int64())])
    parts = vectors.select(vector).mapInArrow(add, "cluster int, dim int, limb int, total long")
    sums: dict[tuple[int, int], int] = {}
    for c, d, limb, total in parts.groupBy("cluster", "dim", "limb").agg(F.sum("total")).collect():
        sums[c, d] = sums.get((c, d), 0) + (total << (LIMB * limb))
    return sums


def _moved(centroids: np.ndarray, sums: dict[tuple[int, int], int]) -> np.ndarray:
    k, dims = centroids.shape
    out = centroids.astype(object)
    for c in range(k):
        if count := sums.get((c, -1)):
            out[c] = [sums.get((c, d), 0) // count for d in range(dims)]
    return out.astype(np.int64) if max(map(abs, out.ravel())) < SMALL else out


def cluster(df: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3",
            key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Cluster, squared distance, inertias and the digest of the final centroid of every vector."""
    spark = df.sparkSession
    vectors = durable(usable(df, dims, key, vector))
    schema = T.StructType([df.schema[key], T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.LongType())])
    centroids = first_centroids(vectors, k, scale, seed, key, vector)
    if not len(centroids):
        return vectors.select(key, *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[1:]],
                              *[F.lit(None).cast(t).alias(n) for n, t in _STATS])
    for _ in range(rounds):
        centroids = _moved(centroids, _sums(vectors, centroids, scale, vector))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, block in _blocks(batches, vector, dims, scale):
            who, away = nearest(block, centroids)
            held = [int(a) if a < LONG else None for a in away.tolist()]
            yield pa.RecordBatch.from_arrays([part.column(key), pa.array(who, pa.int32()), pa.array(held, pa.int64())],
                                             names=[key, "cluster", "distance"])

    found = durable(vectors.mapInArrow(assign, schema))
    # Sums of decimals of 19 digits are exact; one distance too long for a long makes its sums null.
    per = {r[0]: None if r[2] else int(r[1]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(19,0)")), F.max(F.col("distance").isNull())).collect()}
    whole = None if None in per.values() else sum(per.values())
    held = [(c, _long(total), _long(whole), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
            for c, total in per.items()]
    stats = spark.createDataFrame(held, T.StructType([schema["cluster"], *[T.StructField(n, t) for n, t in _STATS]]))
    return found.join(F.broadcast(stats), "cluster").select(key, "cluster", "distance", *[n for n, _ in _STATS])


_STATS = [("cluster_inertia", T.LongType()), ("inertia", T.LongType()), ("centroid_sha256", T.StringType())]


def _long(total: int | None) -> int | None:
    return total if total is not None and total < LONG else None
