"""Duplicate elimination on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import dedup_id, seconds
from tidemark.operators.dedup import (DAY_SECONDS, FIFO_SECONDS, accepted_within_ttl,
                                      first_deliveries)
from tidemark.operators.skew import BROADCAST_ROWS, SPLIT_ROWS
from tidemark.streaming import tables
from tidemark.streaming.sinks import BatchWriter


def drop_repeats(stream: DataFrame, key: str = "message_id", ts: str = "created_at",
                 ttl: float = DAY_SECONDS) -> DataFrame:
    """Remove repeats within ``ttl`` of the first delivery, in keyed state.

    State is freed by the watermark, so an id may be remembered for longer than
    ``ttl``; ``accept_within_ttl`` applies the expiry exactly.
    """
    return stream.withWatermark(ts, f"{int(ttl)} seconds").dropDuplicatesWithinWatermark([key])


def drop_fifo_repeats(stream: DataFrame, body: str = "body", explicit_id: str | None = None,
                      ts: str = "created_at", window: float = FIFO_SECONDS) -> DataFrame:
    keyed = stream.withColumn("dedup_id", dedup_id(explicit_id, body))
    return drop_repeats(keyed, "dedup_id", ts, window)


def _of_batch(earlier: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Earlier rows of the ids in the batch; a batch of checked size is broadcast, so that
    the history is filtered while it is scanned instead of being shuffled."""
    ids = batch.select(F.col(key).alias("_id")).distinct()
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return earlier.join(ids, F.col(key).eqNullSafe(F.col("_id")), "left_semi")


def accept_once(path: str, schema: T.StructType, order: list[str],
                key: str = "message_id") -> BatchWriter:
    """Accept every id once and for ever; the output table is the memory."""
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables.create(spark, path, schema)
        batch = batch.persist()
        try:
            seen = _of_batch(tables.read(spark, path, schema, before=batch_id).select(key),
                             batch, key).select(F.col(key).alias("_seen"))
            fresh = first_deliveries(batch, order, key).join(
                seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")
            tables.put(fresh.select(*schema.fieldNames()), path, batch_id)
        finally:
            batch.unpersist()

    return step


def accept_within_ttl(path: str, schema: T.StructType, order: list[str],
                      ttl: float = DAY_SECONDS, key: str = "message_id",
                      split_rows: int = SPLIT_ROWS) -> BatchWriter:
    """Accept an id again once ``ttl`` has passed since it was last accepted.

    Rows that an earlier batch still rules out are removed first; only the accepted
    rows no older than ``ttl`` before the batch can do that.  The others are folded
    among themselves.  A row that arrives behind an accepted one of its id is a
    duplicate of it.  A row without a time stamp is never accepted.
    """
    ts, names = order[0], schema.fieldNames()

    def fold(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        tables.create(spark, path, schema)
        first = batch.agg(F.min(ts)).first()[0]
        if first is None:
            return batch
        since = F.lit(first).cast(schema[ts].dataType) - seconds(ttl)
        earlier = tables.read(spark, path, schema, before=batch_id).where(F.col(ts) > since)
        last = (_of_batch(earlier, batch, key).groupBy(F.col(key).alias("_key"))
                .agg((F.max(ts) + seconds(ttl)).alias("_expires")))
        free = F.col("_expires").isNull() | (F.col(ts) >= F.col("_expires"))
        open_rows = batch.join(last, F.col(key).eqNullSafe(F.col("_key")), "left") \
            .where(free).select(*names)
        return accepted_within_ttl(open_rows, order, ttl, key, split_rows)

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(*names).where(F.col(ts).isNotNull()).persist()
        try:
            tables.put(fold(batch, batch_id), path, batch_id)
        finally:
            batch.unpersist()

    return step
