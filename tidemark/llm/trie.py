"""Prefix trie of conversations, with subtree totals by time-forward processing.

A node is a distinct sequence of first turns. Its key is a hash chained over the turns, so
equal beginnings share a key wherever they lie. Subtree totals are found by handing messages
from children to parents: nodes are sorted externally by reverse level order, every node
takes its messages from a priority queue that spills to disk, adds its own share and sends
the total on to its parent.

The nodes are dealt into shards first. ``weight`` of a node, the turns that its members have from
there on, is at least the size of its subtree. A light node (``shard_rows`` at most) belongs to the
shard of its topmost light ancestor, which is a whole subtree and small. Heavy nodes, few on
every level, are cut into pieces: runs of ``chunk`` levels with the same smallest member. They get the
totals of light subtrees, added up per parent before they travel; then the tree of pieces, one row
each, is processed across all shard roots, and the pieces once more with what arrives from below.

Hot keys: a conversation's turns are numbered in range-sorted partitions and hashed in chunks, so
a conversation with a third of all rows is no single task's; a first turn or a whole conversation
that a third of all conversations share collapses map-side, and the ids that end in one node are
joined to blocks before one task hashes the blocks.

Rows with a null conv_id belong to no conversation and are left out. A null role or text is an
empty one and a null turn comes first; equal turns are ordered by role, then text, and repeated
rows are turns of their own. Very long texts enter by their hash and length only. An empty table
has no conversation and gives no node. Columns besides the four are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import durable

SHARD_ROWS, CHUNK, BLOCK_IDS, QUEUE_ITEMS = 100_000, 1024, 8192, 200_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class SpillingQueue:
    """A priority queue of tuples that keeps ``limit`` of them in memory and the rest in sorted runs.

    Runs are anonymous files of the task that made them: no other task reads them, they go with
    the process, and a task that is run again makes its own.
    """

    def __init__(self, limit: int = QUEUE_ITEMS):
        self.limit, self.heap, self.heads, self.files = limit, [], [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        """The later half goes to a file; what is due soon stays."""
        items = sorted(self.heap)
        self.heap, late = items[:len(items) // 2], items[len(items) // 2:]
        file = tempfile.TemporaryFile()
        for item in late:
            pickle.dump(item, file)
        file.seek(0)
        self.files.append(file)
        self._advance(len(self.files) - 1)

    def _advance(self, run: int) -> None:
        try:
            heapq.heappush(self.heads, (pickle.load(self.files[run]), run))
        except EOFError:
            self.files[run].close()

    def peek(self) -> tuple | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, run = heapq.heappop(self.heads)
            self._advance(run)
            return item
        return heapq.heappop(self.heap)


# --- turns, rebuilt conversations and their rows --------------------------------------------

def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id, n, digest, chars``: every turn's number from 1, its hash and the length of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    order = ["conv_id", "turn", "role", "text"]
    rows = (conversations.where("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .select("conv_id", digest.alias("digest"), F.length("text").cast("long").alias("chars"),
                    F.spark_partition_id().alias("part")))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, n = None, 0
        for batch in batches:
            numbers = []
            for conv in batch.column("conv_id").to_pylist():
                current, n = (current, n + 1) if conv == current else (conv, 1)
                numbers.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=[*batch.schema.names, "n"])

    local = durable(rows.mapInArrow(number, "conv_id long, digest binary, chars long, part int, n long"))
    # At most two conversations of a partition go on in another: this table has two rows per partition.
    ends = Window.partitionBy("conv_id").orderBy("part")
    sizes = local.groupBy("part", "conv_id").agg(F.max("n").alias("size"))
    crossing = (sizes.join(sizes.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high")), "part")
                .where("conv_id = low OR conv_id = high")
                .select("conv_id", "part", F.sum("size").over(ends.rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
                .where("before IS NOT NULL"))
    return local.join(F.broadcast(crossing), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("n") + F.coalesce("before", F.lit(0))).alias("n"), "digest", "chars")


def rebuilt(turns: DataFrame, group: int = 100, shared: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations by depth, and one row per conversation with its length.

    The base of a conversation gives at most ``shared - 1`` turns to each of its ``group`` conversations.
    """
    own = turns.groupBy("conv_id").agg(F.max("n").alias("own"))
    convs = own.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
                       (F.crc32(F.col("conv_id").cast("string")) % shared).alias("h"))
    bases = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = convs.join(bases, "base", "left").select(
        "conv_id", "base", "own", "h", F.least("h", F.coalesce("base_own", F.lit(0))).alias("head"))
    convs = durable(convs.withColumn("len", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    heads = turns.where((F.col("conv_id") % group == 0) & (F.col("n") < shared)).withColumnRenamed("conv_id", "base")
    first = convs.where("head > 0").join(heads, "base").where("n <= head").select(
        "conv_id", F.col("n").alias("depth"), "digest", "chars", "len")
    rest = turns.join(convs.where("own > h").select("conv_id", "h", "head", "len"), "conv_id").where("n > h").select(
        "conv_id", (F.col("head") + F.col("n") - F.col("h")).alias("depth"), "digest", "chars", "len")
    return first.unionByName(rest), convs.select("conv_id", "len")


def _chain(groups: list[str], value: str, keep: list[str], carry: bool):
    """A scan that chains hashes over sorted rows, beginning anew with each group.

    Adds ``key``, the chain with the row, and ``parent``, the chain before it. With ``carry`` the
    first row of a group is the chain's beginning itself.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chain = None, b""
        for batch in batches:
            keys, parents = [], []
            for *group, data in zip(*[batch.column(c).to_pylist() for c in [*groups, value]]):
                if group != current:
                    current, chain = group, b""
                parents.append(chain)
                chain = data if carry and not chain else hashlib.sha256(chain + data).digest()
                keys.append(chain)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(keys, pa.binary()), pa.array(parents, pa.binary())],
                                             names=[*keep, "key", "parent"])
    return scan


def with_keys(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows with the keys of their node and its parent; the root's is empty.

    Turns are chained within chunks of ``chunk`` levels; a node further down has the hash of the
    key at its chunk's beginning and its chain within the chunk.
    """
    cells = rows.withColumn("chunk", F.expr(f"(depth - 1) div {chunk}"))
    scanned = durable(
        cells.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "depth")
        .mapInArrow(_chain(["conv_id", "chunk"], "digest", ["conv_id", "chunk", "depth", "chars", "len"], False),
                    "conv_id long, chunk long, depth long, chars long, len long, key binary, parent binary"))
    top = scanned.where("chunk = 0").drop("chunk")
    ends = scanned.where(F.col("depth") == (F.col("chunk") + 1) * chunk).where("depth < len")
    starts = (ends.select("conv_id", "chunk", F.col("key").alias("last"))
              .repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
              .mapInArrow(_chain(["conv_id"], "last", ["conv_id", "chunk"], True),
                          "conv_id long, chunk long, key binary, parent binary")
              .select("conv_id", (F.col("chunk") + 1).alias("chunk"), F.col("key").alias("start")))

    def under(key: str) -> Column:
        return F.when(F.col(key) == F.lit(b""), F.col("start")).otherwise(F.unhex(F.sha2(F.concat("start", key), 256)))

    deep = scanned.where("chunk > 0").join(starts, ["conv_id", "chunk"]).select(
        "conv_id", "depth", "chars", "len", under("key").alias("key"), under("parent").alias("parent"))
    return top.unionByName(deep)


# --- subtree totals -------------------------------------------------------------------------

def forward(nodes: DataFrame, shard: list[str], queue_items: int = QUEUE_ITEMS) -> DataFrame:
    """``key, leaves, saved`` added up over the subtree within the shard.

    ``nodes`` have ``key, parent, depth, is_top, leaves, saved``. A node that is its shard's top sends
    nothing. Nodes of several shards may share a task: their keys differ.
    """
    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(queue_items)
        for batch in batches:
            out = []
            for key, parent, depth, is_top, leaves, saved in zip(*[c.to_pylist() for c in batch.columns]):
                while (item := queue.peek()) and item[:2] == (-depth, key):
                    leaves, saved = leaves + item[2], saved + item[3]
                    queue.pop()
                out.append((leaves, saved))
                if not is_top:
                    queue.push((1 - depth, parent, leaves, saved))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *[pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)]], names=["key", "leaves", "saved"])

    dealt = nodes.repartition(*shard) if shard else nodes.repartition(1)
    return (dealt.sortWithinPartitions(F.desc("depth"), "key").select("key", "parent", "depth", "is_top", "leaves", "saved")
            .mapInArrow(process, "key binary, leaves long, saved long"))


def totals(nodes: DataFrame, rows: DataFrame, chunk: int = CHUNK, queue_items: int = QUEUE_ITEMS) -> DataFrame:
    """``key, leaves, saved`` of whole subtrees, from nodes with their own shares."""
    light = nodes.where("NOT heavy")
    # A top's members are those of its shard, so a conversation has one shard at most.
    tops = light.where("is_top").select("key", "depth")
    homes = rows.select("conv_id", "key").join(tops.select("key"), "key").select("conv_id", F.col("key").alias("shard"))
    small = durable(forward(light.join(homes, "conv_id"), ["shard"], queue_items))

    sent = (small.join(light.where("is_top").select("key", "parent"), "key")
            .groupBy(F.col("parent").alias("key")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
    heavy = durable(_receive(nodes.where("heavy"), sent)
                    .withColumn("piece", F.expr(f"depth div {chunk}"))
                    .withColumn("is_top", F.coalesce(F.col("conv_id") != F.col("parent_conv_id"), F.lit(True))
                                | (F.col("depth") % chunk == 0)))
    pieces = ["conv_id", "piece"]
    within = forward(heavy, pieces, queue_items)
    # One row per piece: its number is its key, its parent the piece above, its level that of its top.
    roots = within.join(heavy.where("is_top").drop("leaves", "saved"), "key").select(
        "key", F.col("parent").alias("above"), "depth", "leaves", "saved", _piece("conv_id", F.col("piece")).alias("piece"),
        _piece("parent_conv_id", F.expr(f"(depth - 1) div {chunk}")).alias("piece_above"))
    roots = durable(roots)
    tree = _across(roots, queue_items)
    arrived = (tree.withColumnRenamed("key", "piece").join(roots.select("piece", "above"), "piece").where("above IS NOT NULL")
               .groupBy(F.col("above").alias("key")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
    return small.unionByName(forward(_receive(heavy, arrived), pieces, queue_items))


def _piece(conv: str, number: Column) -> Column:
    return F.concat(F.col(conv).cast("string"), F.lit("/"), number.cast("string")).cast("binary")


def _receive(nodes: DataFrame, sent: DataFrame) -> DataFrame:
    more = nodes.join(sent, "key", "left")
    return (more.withColumn("leaves", F.col("leaves") + F.coalesce("more_leaves", F.lit(0)))
            .withColumn("saved", F.col("saved") + F.coalesce("more_saved", F.lit(0))).drop("more_leaves", "more_saved"))


def _across(roots: DataFrame, queue_items: int) -> DataFrame:
    """Totals of the pieces, by their numbers.

    Pieces hang below pieces of smaller level only; the message of a piece goes to the level of the
    top of the piece above, so it must know that.
    """
    levels = roots.select(F.col("piece").alias("piece_above"), F.col("depth").alias("depth_above"))
    tree = roots.join(levels, "piece_above", "left").select(
        F.col("piece").alias("key"), F.col("piece_above").alias("parent"), "depth", "depth_above",
        F.col("above").isNull().alias("is_top"), "leaves", "saved")

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(queue_items)
        for batch in batches:
            out = []
            for key, parent, depth, above, is_top, leaves, saved in zip(*[c.to_pylist() for c in batch.columns]):
                while (item := queue.peek()) and item[:2] == (-depth, key):
                    leaves, saved = leaves + item[2], saved + item[3]
                    queue.pop()
                out.append((leaves, saved))
                if not is_top:
                    queue.push((-above, parent, leaves, saved))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *[pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)]], names=["key", "leaves", "saved"])

    return (tree.repartition(1).sortWithinPartitions(F.desc("depth"), "key")
            .select("key", "parent", "depth", "depth_above", "is_top", "leaves", "saved")
            .mapInArrow(process, "key binary, leaves long, saved long"))


# --- conversations that end in a node -------------------------------------------------------

def ends_digest(ends: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``key, ends_sha256`` from ``key, conv_id``: ids in ascending order, joined by commas and hashed."""
    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids = None, []

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([ids[0]], pa.int64()),
                                               pa.array([",".join(map(str, ids))])], names=["key", "first", "ids"])

        for batch in batches:
            blocks = []
            for key, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (key != current or len(ids) == block_ids):
                    blocks.append(block())
                    ids = []
                current = key
                ids.append(conv)
            if blocks:
                yield pa.Table.from_batches(blocks).combine_chunks().to_batches()[0]
        if ids:
            yield block()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha, done = None, None, []
        for batch in batches:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if key == current and sha is not None:
                    sha.update(b",")
                else:
                    if sha is not None:
                        done.append((current, sha.hexdigest()))
                    current, sha = key, hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield result(done)
                done = []
        if sha is not None:
            yield result([(current, sha.hexdigest())])

    def result(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done])],
                                          names=["key", "ends_sha256"])

    order = ["key", "conv_id"]
    blocks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        join_ids, "key binary, first long, ids string")
    return blocks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, group: int = 100, shared: int = 6, shard_rows: int = SHARD_ROWS,
                chunk: int = CHUNK, queue_items: int = QUEUE_ITEMS, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; the keys stay in ``key`` and ``parent``."""
    turns = numbered(conversations)
    rows, convs = rebuilt(turns, group, shared)
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"), "len",
                        F.lit(b"").alias("key"), F.lit(None).cast("binary").alias("parent"))
    rows = durable(with_keys(rows, chunk).unionByName(root))

    # Parent, depth and length follow from the key; grouping by them keeps the aggregation on hashes.
    nodes = durable(rows.groupBy("key", "parent", "depth", "chars").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight")))
    heavy = (F.col("weight") > shard_rows) | (F.col("depth") == 0)
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), heavy.alias("parent_heavy"))
    nodes = durable(
        nodes.join(children, "key", "left").join(parents, "parent", "left")
        .select("key", "parent", "depth", "conv_id", "parent_conv_id", "n_convs",
                F.coalesce("n_children", F.lit(0)).alias("n_children"),
                heavy.alias("heavy"), (~heavy & F.coalesce("parent_heavy", F.lit(True))).alias("is_top"),
                F.col("n_children").isNull().cast("long").alias("leaves"),
                ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")))
    found = totals(nodes, rows, chunk, queue_items).select(
        "key", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    ends = ends_digest(rows.where("depth = len"), block_ids)
    return nodes.drop("leaves", "saved", "heavy", "is_top").join(found, "key").join(ends, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"), "key", "parent")
