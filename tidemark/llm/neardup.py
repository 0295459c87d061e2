"""Near-duplicate classes by DartMinHash signatures, banded joins and exact checks.

Each shingle owns, per layer of its weight, a region of the plane of weight and rank. Darts
fall on it as a unit-rate Poisson process that depends on the shingle alone: a hash gives the
number of darts in each unit cell, and their places. A text takes the darts up to a rank that
makes it expect k*ln(k) + 2*k of them in all, so a long text hashes few darts per shingle. A
dart belongs to one of k coordinates, and the earliest dart of a coordinate is its sign. Texts
that leave a coordinate empty throw again over twice the rank.

Documents with equal words are one node. Nodes that share a band are candidates: each with the
smallest node of the band, and, where the links found so far leave a band in several classes,
across these classes: as pairs in small bands, in blocks within one task in large ones. Every candidate's similarity is computed exactly from its words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, durable, slices, words_of

SHINGLE, SIMILARITY = 5, 0.8
#: At similarity 0.8 two texts share none of the bands once in 12,000 pairs.
BANDS, ROWS = 40, 7
#: Members that one task compares with one leader.
CELL = 64
#: Bands of up to so many nodes give pairs; the nodes of larger ones meet in blocks of this size.
FEW, BLOCK = 8, 128
WORDS_KEPT = 200_000
#: Bytes of text whose darts are thrown at once: some 20 arrays of a number a word each.
SKETCHED = 3 << 20

MIX1, MIX2, GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: Ranks are whole cells and 44 binary places.
PLACES, NEVER = float(1 << 44), np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)) * 2.0 ** -53


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles_of(words: list[bytes], hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of ``size`` words; of all words where there are fewer; none without words."""
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    return shingle_hashes(ids, size)


def shingle_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    if not len(ids):
        return ids
    size = min(size, len(ids))
    rolled = np.zeros(len(ids) - size + 1, np.uint64)
    for i in range(size):
        rolled = (rolled + ids[i:len(ids) - size + 1 + i]) * (GOLD | np.uint64(1))
        rolled ^= rolled >> np.uint64(29)
    return mixed(rolled)


def poisson_steps(area: float = 1.0, most: int = 18) -> np.ndarray:
    """Distribution function of the number of darts in a region."""
    terms = [math.exp(-area) * area ** n / math.factorial(n) for n in range(most)]
    return np.cumsum(terms)


def signatures(shingles: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int, k: int) -> np.ndarray:
    """``k`` signs for each of ``texts``, whose ``owner`` each weighted shingle names.

    Weights are cut into layers of height 1; a dart of the top layer counts if it lies below the
    weight. A sign is the rank of the coordinate's earliest dart, whose 44 binary places come
    from the dart's hash and so name the dart as well. A text without shingles keeps zeros.
    """
    signs = np.full(texts * k, NEVER)
    total = np.bincount(owner, weights, texts)
    reach = np.divide(k * math.log(k) + 2 * k, total, out=np.zeros(texts), where=total > 0)
    layers = np.ceil(weights).astype(np.int64)
    each = np.repeat(np.arange(len(shingles)), layers)
    layer = np.arange(len(each)) - np.repeat(np.cumsum(layers) - layers, layers)
    region = mixed(shingles[each] + layer.astype(np.uint64) * GOLD)
    owners, height = owner[each], np.minimum(weights[each] - layer, 1.0)
    low, open_ = np.zeros(texts), total > 0
    while open_.any():
        some = np.flatnonzero(open_[owners])
        throw(region[some], owners[some], height[some], low, reach, signs, k)
        open_ &= (signs.reshape(texts, k) == NEVER).any(axis=1)
        low, reach = reach, 2 * reach
    signs[signs == NEVER] = 0
    return signs.reshape(texts, k)


def throw(region: np.ndarray, owners: np.ndarray, height: np.ndarray, low: np.ndarray, reach: np.ndarray, signs: np.ndarray, k: int) -> None:
    """Keep each coordinate's earliest dart among those with ranks from ``low`` to ``reach`` of its text."""
    first, last, cell = np.floor(low)[owners], np.ceil(reach)[owners], 0
    whole, steps = bool((height >= 1.0).all()), poisson_steps()
    from_, to = (low * PLACES).astype(np.uint64), (reach * PLACES).astype(np.uint64)
    alive = np.arange(len(region))
    while len(alive):
        at = alive if not cell and not first.any() else alive[first[alive] <= cell]
        if not len(at):
            cell = int(first[alive].min())
            continue
        base = mixed(region[at] ^ (np.array([cell + 1], np.uint64) * MIX2))
        number = np.searchsorted(steps, uniform(base), side="right")
        # The first dart of a cell is thrown for all that have one, then the second, and so on.
        for d in range(len(steps)):
            more = np.flatnonzero(number > d)
            if not len(more):
                break
            at, base, number = at[more], base[more], number[more]
            dart = mixed(base + np.array([d + 1], np.uint64) * GOLD)
            rank, who = (dart >> np.uint64(20)) + np.uint64(cell << 44), owners[at]
            hit = (rank < to[who]) & (rank >= from_[who])
            if not whole:
                hit &= uniform(mixed(dart ^ GOLD)) <= height[at]
            hit = np.flatnonzero(hit)
            coordinate = mixed(dart[hit] ^ MIX1) % np.uint64(k)
            np.minimum.at(signs, who[hit] * k + coordinate.astype(np.int64), rank[hit])
        cell += 1
        alive = alive[last[alive] > cell]


def band_keys(signs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signs), bands), np.uint64)
    for r in range(rows):
        keys = mixed(keys * GOLD + signs.reshape(len(signs), bands, rows)[:, :, r])
    return keys


def sketch(df: DataFrame, weights: str, bands: int, rows: int, shingle: int) -> DataFrame:
    """``doc_id, text_key, digest, shingles, bands`` from ``doc_id, text, text_key``; no bands for a text without words.

    ``digest`` names the words in their order; equal words make one node.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part in slices(batches, limit=SKETCHED):
            if len(hashes) > WORDS_KEPT:
                hashes = WordHashes()
            found, digests = [], []
            for text in part.column("text").cast(pa.binary()).to_pylist():
                words = text.split() if text else []
                found.append(shingles_of(words, hashes, shingle))
                digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
            if weights == "count":
                pairs = [np.unique(f, return_counts=True) for f in found]
                found, weight = [p[0] for p in pairs], np.concatenate([np.zeros(0), *(p[1] for p in pairs)])
                sizes = np.array([len(f) for f in found], np.int64)
            else:
                found = [np.unique(f) for f in found]
                sizes = np.array([len(f) for f in found], np.int64)
                weight = np.ones(int(sizes.sum()))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            signs = signatures(np.concatenate([np.zeros(0, np.uint64), *found]), weight, owner, len(sizes), bands * rows)
            keys = band_keys(signs, bands, rows).view(np.int64)
            offsets = np.r_[0, np.cumsum(np.where(sizes > 0, bands, 0))].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[sizes > 0].reshape(-1)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(digests, pa.binary()), pa.array(sizes), lists],
                                             names=["doc_id", "text_key", "digest", "shingles", "bands"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(run, f"doc_id {kind}, text_key long, digest binary, shingles long, bands array<long>")


def elements(shingles: np.ndarray, weights: str) -> np.ndarray:
    """Sorted set whose Jaccard similarity is that of the shingle sets, or of the bags for "count".

    The n-th occurrence of a shingle in a bag is an element of its own.
    """
    if weights != "count" or not len(shingles):
        return np.unique(shingles)
    ordered = np.sort(shingles)
    turn = np.arange(len(ordered)) - np.searchsorted(ordered, ordered, side="left")
    return np.sort(mixed(ordered + turn.astype(np.uint64) * GOLD))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of sorted sets."""
    both = len(a) + len(b) - len(np.union1d(a, b))
    return both / max(1, len(a) + len(b) - both)


def similarities(sets: list[np.ndarray]) -> np.ndarray:
    """Jaccard similarities of all pairs of sets, by products of slabs of their incidence matrix."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, element, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column, keep = np.cumsum(shared) - 1, shared[element]
    column, owner = column[element[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner, both = column[order], owner[order], np.zeros((len(sets), len(sets)))
    for start in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, (start, start + 4096))
        slab = np.zeros((len(sets), 4096), np.float32)
        slab[owner[a:b], column[a:b] - start] = 1
        both += slab @ slab.T
    return both / np.maximum(1, sizes[:, None] + sizes - both)


def crossing(left: DataFrame, texts: DataFrame, weights: str, least: float, shingle: int) -> DataFrame:
    """Links ``a, b`` between different classes within the bands of ``left`` (``band, hash, nodes, node, label``).

    A band's nodes are dealt into blocks, and every two blocks meet in one place, where all their
    similarities are computed at once. Only links are emitted.
    """
    blocks = F.ceil(F.col("nodes") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = (left.select("band", "hash", "node", "label", block.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
            .select("band", "hash", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "label"))
    group = ["band", "hash", "low", "high"]
    rows = rows.join(texts, "node").repartition(*group).sortWithinPartitions(*group, "node")

    def meet(nodes: list, labels: list, sets: list) -> pa.RecordBatch:
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(set(labels)) > 1:
            label, name = np.array(labels), np.array(nodes)
            hit = (similarities(sets) >= least - 1e-12) & (label[:, None] != label) & (name[:, None] > name)
            a, b = (name[i] for i in np.nonzero(hit))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, nodes, labels, sets = WordHashes(), None, [], [], []
        for part in slices(batches):
            if len(hashes) > WORDS_KEPT:
                hashes = WordHashes()
            for band, hash_, low, high, node, label, words in zip(*(part.column(c).to_pylist() for c in (*group, "node", "label")), words_of(part)):
                if (band, hash_, low, high) != last:
                    yield meet(nodes, labels, sets)
                    last, nodes, labels, sets = (band, hash_, low, high), [], [], []
                if not nodes or nodes[-1] != node:
                    nodes.append(node)
                    labels.append(label)
                    sets.append(elements(shingles_of(words, hashes, shingle), weights))
        yield meet(nodes, labels, sets)

    return rows.select(*group, "node", "label", "text").mapInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, weights: str, least: float, shingle: int) -> DataFrame:
    """The pairs ``a, b`` whose texts reach the similarity.

    Members meet their leader in cells of bounded size: the leader's text comes first, the
    others stream past it.
    """
    leaders = pairs.groupBy(F.col("b").alias("leader")).agg(F.ceil(F.count("*") / CELL).cast("int").alias("cells"))
    member = pairs.select(F.col("b").alias("leader"), F.col("a").alias("node")).join(leaders, "leader").select(
        "leader", F.pmod(F.xxhash64("node"), "cells").cast("int").alias("cell"), F.lit(1).alias("role"), "node")
    leader = leaders.select("leader", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"),
                            F.lit(0).alias("role"), F.col("leader").alias("node"))
    rows = member.unionByName(leader).join(texts, "node").repartition("leader", "cell").sortWithinPartitions("leader", "cell", "role", "node")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, last, own = WordHashes(), None, None, None
        for part in slices(batches):
            if len(hashes) > WORDS_KEPT:
                hashes = WordHashes()
            found: tuple[list, list] = ([], [])
            for leader, cell, role, node, words in zip(*(part.column(c).to_pylist() for c in ("leader", "cell", "role", "node")), words_of(part)):
                if (leader, cell, node) == last:
                    continue
                last, bag = (leader, cell, node), elements(shingles_of(words, hashes, shingle), weights)
                if not role:
                    held, own = bag, (leader, cell)
                elif own == (leader, cell) and min(len(bag), len(held)) >= least * max(len(bag), len(held)) and similarity(bag, held) >= least - 1e-12:
                    found[0].append(node)
                    found[1].append(leader)
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())], names=["a", "b"])

    return rows.select("leader", "cell", "role", "node", "text").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` with the smallest node of each connected component, for nodes with links.

    Every round gives a node the smallest label around it and then that label's own label, so
    labels travel in doubling steps. Each round is a written table.
    """
    both = durable(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        nearer = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = durable(nearer.join(hop, "label").select("node", "old", F.least("label", "further").alias("label")))
        if moved.where("label <> old").isEmpty():
            return moved.select("node", "label")
        labels = moved.select("node", "label")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", weights: str = "set",
                    least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """``key, text_key, class_id, head`` per row of ``df``.

    ``weights`` is "set" for Jaccard similarity of shingle sets or "count" for bags. A class is a
    connected component of nodes; ``class_id`` is the smallest key in it (null if it has none).
    ``head`` marks the rows with that key and its text; equal rows are all marked. ``text_key``
    is a hash of the text. Texts of fewer than five words have one shingle; texts without
    words, and nulls, are alone, each with its own key as class.
    """
    narrow = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).withColumn("text_key", F.xxhash64("text"))
    all_rows = durable(sketch(narrow, weights, bands, rows, shingle).withColumn("row", F.monotonically_increasing_id()))
    nodes = all_rows.where("shingles > 0").groupBy("digest").agg(F.min("row").alias("node"))
    owners = durable(all_rows.join(nodes.select("digest", F.col("node").alias("row")), ["digest", "row"], "left_semi")
                     .select(F.col("row").alias("node"), "doc_id", "text_key", "shingles", "bands"))
    banded = owners.select("node", "shingles", F.posexplode("bands").alias("band", "hash"))
    shared = banded.groupBy("band", "hash").agg(F.min("node").alias("leader"), F.count("*").alias("nodes")).where("nodes > 1")
    members = durable(banded.join(shared.select("band", "hash", "leader"), ["band", "hash"]))
    wanted = owners.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("doc_id").alias("id"), F.col("text_key").alias("its"))
    # Rows with the same id and text give a node its text more than once; all but one are passed over.
    texts = durable(narrow.join(wanted, F.expr("doc_id <=> id AND text_key = its")).select("node", "text"))
    stars = durable(members.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct())
    links = durable(verified(stars, texts, weights, least, shingle))
    labels = components(links)
    # Bands that the links leave in several classes are searched across these classes.
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = labelled.groupBy("band", "hash").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("nodes")).where("low < high")
    left = durable(labelled.join(split.select("band", "hash", "nodes"), ["band", "hash"]))
    few = left.where(F.col("nodes") <= FEW)
    other = few.select("band", "hash", F.col("node").alias("b"), F.col("label").alias("other"), F.col("shingles").alias("more"))
    alike = F.least("shingles", "more") >= (least if weights == "set" else 0.0) * F.greatest("shingles", "more")
    across = (few.join(other, ["band", "hash"]).where((F.col("label") != F.col("other")) & (F.col("node") > F.col("b")) & alike)
              .select(F.col("node").alias("a"), "b").distinct().join(stars, ["a", "b"], "left_anti"))
    more = durable(verified(durable(across), texts, weights, least, shingle)
                   .unionByName(crossing(left.where(F.col("nodes") > FEW), texts, weights, least, shingle)))
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    classes = nodes.join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("label"))
    worded = durable(all_rows.where("shingles > 0").join(classes, "digest").select("doc_id", "text_key", "row", "label"))
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    heads = (worded.groupBy("label").agg(F.min(first).alias("first"))
             .join(worded.select(F.col("row").alias("its_row"), F.col("text_key").alias("its_text")), F.expr("first.row = its_row"))
             .select("label", F.col("first.doc_id").alias("class_id"), "its_text"))
    found = worded.join(heads, "label").select("doc_id", "text_key", "class_id", F.expr("doc_id <=> class_id AND text_key = its_text").alias("head"))
    alone = all_rows.where("shingles = 0").select("doc_id", "text_key", F.col("doc_id").alias("class_id"), F.lit(True).alias("head"))
    return found.unionAll(alone).withColumnRenamed("doc_id", key)


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of ``df`` for each class of near-duplicates, with all columns: the one with the smallest key.

    Of equal rows one stays. Texts without words all stay.
    """
    classes = near_duplicates(df, key, text, **options).where("head")
    heads = classes.select(F.col(key).alias("id"), F.col("text_key").alias("its")).distinct()
    worded = F.coalesce(F.col(text).rlike(WORD), F.lit(False))
    row = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_key"), worded.alias("worded"))
    kept = row.where("worded").join(heads, F.expr("doc_id <=> id AND text_key = its"))
    one = Window.partitionBy("doc_id", "text_key").orderBy(F.xxhash64("row"))
    kept = kept.withColumn("place", F.row_number().over(one)).where("place = 1").select("row.*")
    return kept.unionAll(row.where("NOT worded").select("row.*"))
