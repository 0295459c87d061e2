"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import durable

#: Texts are handled in slices of so many bytes, whatever the size of an Arrow batch.
SLICE_BYTES = 4 << 20
#: The words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "durable", "give_back", "id_crc", "read", "slices", "texts_of", "words_of"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_crc(column: str = "doc_id") -> Column:
    """CRC-32 of an id written as text; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")), F.lit(0).cast("long"))


def give_back() -> None:
    """Return freed memory to the system; Python workers live on after their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice have ``limit`` bytes, or one row, at most.

    What a batch has left is given back before the next one is read.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
        del batch
        give_back()


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; a null is an empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def words_of(batch: pa.RecordBatch, column: str = "text") -> list[list[bytes]]:
    """Words between ASCII white space, in UTF-8; none for a null."""
    return [t.split() if t else [] for t in batch.column(column).cast(pa.binary()).to_pylist()]
