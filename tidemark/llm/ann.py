"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A vector's difference from a centre is rotated at random and kept as one sign bit per dimension
with two scalars: its length, and its inner product with its own code. From these the inner
product with a query is estimated together with a bound of the error. Only vectors whose upper
bound reaches the k-th best exact score so far are scored exactly.

Queries and codes meet in blocks: each task holds one block of codes and one of queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import durable

TOP, SEED = 20, 8
#: Rows whose mean is the centre; codes and queries of one task; codes compared at a time.
CENTRE_ROWS, SHARD_ROWS, QUERY_ROWS, CHUNK = 4_096, 32_768, 2_048, 1_024
#: Standard errors that the bound allows for.
ERRORS = 4.0


def usable(vector: str) -> str:
    """SQL condition: not null, not all zero, every component a finite number."""
    return (f"{vector} IS NOT NULL AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
            f" AND exists({vector}, x -> x <> 0)")


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def exponents(rows: np.ndarray) -> np.ndarray:
    """Per row the power of two that its largest component stays below."""
    return np.frexp(np.abs(rows).max(axis=1, initial=0.0))[1]


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, distances from the centre, and inner products of unit differences with their codes.

    Rows are scaled by powers of two on the way, so no component is too small or too large to be
    squared; a distance that no double holds is infinite.
    """
    power = np.maximum(exponents(vectors), exponents(centre[None, :]))[:, None] + 1
    difference = (np.ldexp(vectors, -power) - np.ldexp(centre, -power)) @ turn
    length = np.linalg.norm(difference, axis=1)
    code = difference > 0
    match = np.abs(difference).sum(axis=1) / math.sqrt(vectors.shape[1]) / np.where(length > 0, length, 1)
    with np.errstate(over="ignore"):
        return np.packbits(code, axis=1), np.ldexp(length, power[:, 0]), np.where(length > 0, match, 1.0)


def estimates(codes: np.ndarray, length: np.ndarray, match: np.ndarray, queries: np.ndarray, centre: np.ndarray,
              turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Estimated inner products (vectors by queries), how far they may be off, and their power of two.

    Queries have components below 1; lengths and centre are divided by a common power of two.
    Estimates of vectors with an infinite length are no numbers.
    """
    dim = queries.shape[1]
    finite = np.where(np.isfinite(length), length, 0.0)
    power = int(max(np.frexp(finite.max(initial=0.0))[1], exponents(centre[None, :])[0]))
    length, centre = np.where(np.isfinite(length), np.ldexp(finite, -power), np.nan), np.ldexp(centre, -power)
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    turned = (queries @ turn).astype(np.float32)
    scale = (length / match / math.sqrt(dim)).astype(np.float32)
    value = (signs @ turned.T) * scale[:, None] + (queries @ centre).astype(np.float32)
    spread = length * np.sqrt(np.maximum(1 - match ** 2, 0)) / match / math.sqrt(max(dim - 1, 1))
    size = np.linalg.norm(queries, axis=1)
    off = ERRORS * spread[:, None] * size + 1e-5 * ((length + np.linalg.norm(centre))[:, None] * size + 1e-20)
    return value, off.astype(np.float32), power


def scaled_floor(floor: np.ndarray, power: np.ndarray, dim: int) -> np.ndarray:
    """Scores divided by powers of two, less what double precision may have lost of them."""
    with np.errstate(over="ignore", invalid="ignore"):
        least = np.ldexp(np.clip(floor, -np.finfo(float).max, np.finfo(float).max), -power) - np.ldexp(dim * 2.0 ** -1073, -power)
    return np.where(np.isneginf(floor) | np.isnan(least), -np.inf, least)


def products(vectors: np.ndarray, queries: np.ndarray, at: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Exact inner products of pairs, in double precision and a fixed order of addition.

    A product beyond the largest double is infinite, never undefined.
    """
    found = np.empty(len(at))
    for i in range(0, len(at), 65_536):
        part = slice(i, i + 65_536)
        v, q = vectors[at[part]], queries[of[part]]
        with np.errstate(over="ignore", invalid="ignore"):
            score = (v * q).sum(axis=1)
        lost = np.flatnonzero(~np.isfinite(score))
        if len(lost):  # too large on the way: the same at a smaller size
            v, q = v[lost], q[lost]
            power = exponents(v) + exponents(q)
            total = (np.ldexp(v, -exponents(v)[:, None]) * np.ldexp(q, -exponents(q)[:, None])).sum(axis=1)
            with np.errstate(over="ignore"):
                score[lost] = np.ldexp(total, power)
        found[part] = score
    return found


def best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` best, ties to the smaller id; one place per query and id, that of its best score."""
    order = np.lexsort((-scores, ids, query))
    q, i = query[order], ids[order]
    order = order[~np.r_[False, (q[1:] == q[:-1]) & (i[1:] == i[:-1])][:len(order)]]
    order = order[np.lexsort((-scores[order], query[order]))]  # stable: equal scores stay in the order of ids
    q = query[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    return order[rank < k]


def scan(ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, length: np.ndarray, match: np.ndarray, query_ids: np.ndarray,
         queries: np.ndarray, centre: np.ndarray, turn: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query places, ids and exact scores of the best ``k`` of a block for each query."""
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    floor = np.full(len(queries), -np.inf)
    sizes = exponents(queries)
    small = np.ldexp(queries, -sizes[:, None])
    for a in range(0, len(ids), CHUNK):
        part = slice(a, a + CHUNK)
        value, off, power = estimates(codes[part], length[part], match[part], small, centre, turn)
        other = ids[part][:, None] != query_ids
        if np.isinf(floor).any() and len(value) > k:
            # The first exact scores are those of the best estimates.
            first = np.argpartition(-np.where(other, np.nan_to_num(value, nan=np.inf), -np.inf), k, axis=0)[:k].T.ravel()
            of = np.repeat(np.arange(len(queries)), k)
            scores = products(vectors[part], queries, first, of)
            scores[~other[first, of]] = -np.inf
            # Rows of one id are one neighbour: only k different ids make a floor.
            top = best(of, ids[part][first], scores, k)
            least = np.full(len(queries), -np.inf)
            least[of[top]] = scores[top]  # falling within each query
            floor = np.maximum(floor, np.where(np.bincount(of[top], minlength=len(queries)) == k, least, -np.inf))
        at, of = np.nonzero(~(value + off < scaled_floor(floor, sizes + power, queries.shape[1])) & other)
        scores = products(vectors[part], queries, at, of)
        near = scores >= floor[of]
        at, of, scores = at[near], of[near], scores[near]
        query, who, score = np.r_[held[0], of], np.r_[held[1], ids[part][at]], np.r_[held[2], scores]
        top = best(query, who, score, k)
        held = (query[top], who[top], score[top])
        full = np.bincount(held[0], minlength=len(queries)) >= k
        last = np.full(len(queries), -np.inf)
        last[held[0]] = held[2]  # best() leaves each query's scores in falling order
        floor = np.maximum(floor, np.where(full, last, -np.inf))
    return held


def matrix(column: pa.ChunkedArray, dim: int, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def build_index(df: DataFrame, key: str = "vec_id", vector: str = "embedding", seed: int = SEED) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """``vec_id, dim, code, length, match, vector`` for every usable row, copies once, and the centre for each dimension.

    Centres are means of at most ``CENTRE_ROWS`` rows, those first in hash order.
    """
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).where(
        f"vec_id IS NOT NULL AND {usable('vector')}")
    # Copies of a row fall together wherever rows are dealt by hash; tasks drop their own before the shuffle.
    rows = durable(rows.distinct())
    groups: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(CENTRE_ROWS).collect():
        groups.setdefault(len(r["vector"]), []).append(r["vector"])
    centres = {dim: (np.array(found) / len(found)).sum(axis=0) for dim, found in sorted(groups.items())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = {}
        for batch in batches:
            lists = batch.column("vector")
            dims = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy()
            start = np.cumsum(dims) - dims
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                vectors = values[start[at][:, None] + np.arange(dim)]
                turn = turns.setdefault(dim, rotation(dim, seed))
                codes, length, match = encode(vectors, centres.get(dim, np.zeros(dim)), turn)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(at)), pa.array([dim] * len(at), pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()),
                     pa.array(length), pa.array(match), pa.array([v.tobytes() for v in vectors], pa.binary())],
                    names=["vec_id", "dim", "code", "length", "match", "vector"])

    return rows.mapInArrow(run, "vec_id long, dim int, code binary, length double, match double, vector binary"), centres


def search(df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = TOP, seed: int = SEED) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of every row whose key ``every`` divides.

    Rows without a key, and vectors that are null, zero or not finite, take no part; vectors meet
    those of their own dimension. Rows with the query's key are its own and no candidates. A
    repeated key counts once, with its best score. Fewer candidates than ``k`` are all returned.
    """
    index, centres = build_index(df, key, vector, seed)
    index = durable(index)
    asks = F.col("vec_id") % every == 0
    sizes = index.groupBy("dim").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("shards"),
                                     F.ceil(F.count_if(asks) / QUERY_ROWS).cast("int").alias("blocks")).where("blocks > 0")
    rows = index.join(sizes, "dim")
    place = F.xxhash64("vec_id", "vector")
    codes = rows.select("dim", F.pmod(place, "shards").cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                        "vec_id", "code", "length", "match", "vector")
    asked = index.where(asks).join(sizes, "dim")
    queries = asked.select("dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
                           F.pmod(place, "blocks").cast("int").alias("block"), "vec_id", "vector").toDF("dim", "shard", "block", "vec_id", "vector")

    def meet(group: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        names = right.column("vec_id").to_numpy()
        if left.num_rows and right.num_rows:
            dim = group[0].as_py()
            found = scan(left.column("vec_id").to_numpy(), matrix(left.column("vector"), dim, np.float64), matrix(left.column("code"), (dim + 7) // 8, np.uint8),
                         left.column("length").to_numpy(), left.column("match").to_numpy(), names, matrix(right.column("vector"), dim, np.float64),
                         centres.get(dim, np.zeros(dim)), rotation(dim, seed), k)
        return pa.table({"query_id": names[found[0]], "vec_id": found[1], "score": found[2]})

    keys = ["dim", "shard", "block"]
    found = codes.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
