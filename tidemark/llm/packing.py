"""Pack documents along a space-filling curve, so that neighbours in content share sequences.

A document's token ids are hashed into a signed vector, projected to a few dimensions and
placed on a Hilbert curve. Documents are range-sorted by that key, laid end to end in each
partition, and cut every ``length`` tokens. What is left at the end of a partition is cut into
powers of two, which need no padding.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import durable, slices, texts_of

LENGTH, END_ID = 1024, 0
VECTOR, DIMENSIONS, BITS = 256, 4, 15
PIECES = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of a byte-level BPE vocabulary file of the ``tokenizers`` library.

    The vocabulary, split pattern and special tokens come from that file. ``tiktoken`` merges by
    the same ranks several times as fast; a text that holds a special token's string, and any
    vocabulary that isn't plain byte-level BPE, goes to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.slow, self.fast = Tokenizer.from_file(path), None
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.size = self.slow.get_vocab_size()
        split, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if model["type"] == "BPE" and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and not spec.get("normalizer"):
            self.fast = self.by_rank(model["vocab"])

    def by_rank(self, vocab: dict[str, int]):
        import public_tokenizers
        import tiktoken

        # Byte-level vocabularies write the bytes that print as themselves, the rest from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(byte[c] for c in piece): i for piece, i in vocab.items() if piece not in self.special}
        return tiktoken.Encoding("by_rank", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [e.ids for e in self.slow.encode_batch(texts, add_special_tokens=False)]
        return [self.slow.encode(t, add_special_tokens=False).ids if any(s in t for s in self.special)
                else self.fast.encode_ordinary(t) for t in texts]


def projection(seed: int = 3) -> np.ndarray:
    """Random directions for vectors of hashed ids."""
    return np.random.default_rng(seed).standard_normal((VECTOR, DIMENSIONS)).astype(np.float32)


def hashed(ids: np.ndarray) -> np.ndarray:
    """Signed counts of ids by bucket, damped and of length 1 (0 for no ids)."""
    mixed = ids.astype(np.uint32) * np.uint32(2654435761)
    sign = 1.0 - 2.0 * ((mixed >> np.uint32(8)) & np.uint32(1))
    vector = np.bincount(mixed >> np.uint32(24), sign, VECTOR)
    vector = np.sign(vector) * np.sqrt(np.abs(vector))
    return vector / (np.linalg.norm(vector) or 1.0)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each row of integer coordinates on the Hilbert curve (Skilling's transform)."""
    x = points.T.astype(np.uint64).copy()
    n, one = len(x), np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        p = q - one
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & p
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = np.where(flip, x[i], x[i] ^ swap)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        t = np.where((x[n - 1] & q) != 0, t ^ (q - one), t)
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key.astype(np.int64)


def curve_keys(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Hilbert keys of unit vectors: projections are spread evenly before they are cut to bits."""
    spread = 1 / (1 + np.exp(-1.702 * 2 * (vectors @ directions)))
    return hilbert_keys(np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def encode(df: DataFrame, key: str, text: str, vocabulary: str, end_id: int) -> DataFrame:
    """``key, curve, tie, ids`` per row: packed ids with the end id, 16 bits each where they fit."""
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, directions = Encoder(vocabulary), projection()
        kind = np.uint16 if encoder.size <= 1 << 16 else np.uint32
        for part in slices(batches):
            ids = [np.array(found, kind) for found in encoder(texts_of(part))]
            keys = curve_keys(np.array([hashed(i) for i in ids]), directions)
            packed = [np.append(i, kind(end_id)).tobytes() for i in ids]
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(keys, pa.int64()), pa.array([zlib.crc32(p) for p in packed], pa.int64()),
                                              pa.array([kind().itemsize] * len(ids), pa.int32()), pa.array(packed, pa.binary())],
                                             names=["key", "curve", "tie", "width", "ids"])

    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(run, f"key {kind}, curve long, tie long, width int, ids binary")


def tail_lengths(rest: int) -> list[int]:
    """Powers of two that add up to ``rest``, longest first."""
    return [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None,
         length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of documents in sequences; with ``with_ids`` also each piece's ids.

    A null or empty text is its end id alone. Rows that are equal are packed one after the
    other. A sequence id is the partition's number and a count in it. An empty table gives no
    pieces. The encoded rows are written once, so ids and order hold when a task is repeated.
    """
    encoded = durable(encode(df, key, text, vocabulary or default_vocabulary(), end_id))
    order = ["curve", "tie", "key"]
    ranged = encoded.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kind = encoded.schema["key"].dataType.simpleString()
    schema = PIECES.format(kind=kind) + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # of the open sequence: key, start, document's tokens, ids
        filled, number, part, key_type = 0, 0, 0, None
        ready: list[tuple] = []

        def close(pieces: list[tuple]) -> None:
            nonlocal number
            at = 0
            for name, start, total, ids in pieces:
                ready.append((name, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, (part << 33) + number, at, *([ids.astype(np.int32)] if with_ids else [])))
                at += len(ids)
            number += 1

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*ready), [key_type, *[pa.int64()] * 6, *([pa.list_(pa.int32())] if with_ids else [])])]
            ready.clear()
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])])

        for batch in batches:
            key_type = batch.schema.field("key").type
            for name, ids, width, part in zip(*(batch.column(c).to_pylist() for c in ("key", "ids", "width", "part"))):
                ids, at = np.frombuffer(ids, np.uint16 if width == 2 else np.uint32), 0
                while at < len(ids):
                    take = min(length - filled, len(ids) - at)
                    held.append((name, at, len(ids), ids[at:at + take]))
                    at, filled = at + take, filled + take
                    if filled == length:
                        close(held)
                        held, filled = [], 0
                if len(ready) >= 10_000:
                    yield flush()
        for size in tail_lengths(filled):
            pieces, left = [], size
            while left:
                name, start, total, ids = held.pop(0)
                pieces.append((name, start, total, ids[:left]))
                if len(ids) > left:
                    held.insert(0, (name, start + left, total, ids[left:]))
                left -= len(pieces[-1][3])
            close(pieces)
        if ready:
            yield flush()

    return ranged.mapInArrow(cut, schema).withColumnRenamed("doc_id", key)
