"""Late rows as an output of their own, instead of rows that a watermark drops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import epoch_micros
from tidemark.streaming import tables
from tidemark.streaming.sinks import BatchWriter


def split_late(on_time: BatchWriter, late: BatchWriter, marks: str, ts: str, grace_seconds: float = 0) -> BatchWriter:
    """A step that sends rows behind the watermark in force to a sink of their own.

    The watermark of a micro-batch is the newest ``ts`` of all earlier ones, less the grace; the first
    has none. A row exactly at the watermark is on time, one without a time stamp is late. Each batch
    leaves its mark, one row, below ``marks`` and reads only that of the batch before it, so a replayed
    batch is split as it was at first.
    """
    grace = round(grace_seconds * 1_000_000)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, newest = batch.sparkSession, None
        if batch_id > 0:
            newest = spark.read.schema("newest long").parquet(f"{marks}/{tables.BATCH}={batch_id - 1}").first()[0]
        at = epoch_micros(ts)
        behind = F.lit(False) if newest is None else at < newest - grace
        batch = batch.persist()
        try:
            marked = F.coalesce(behind, F.lit(True)) if newest is not None else at.isNull()
            late(batch.where(marked), batch_id)
            on_time(batch.where(~marked), batch_id)
            # One row: greatest ignores the null of a batch without rows.
            tables.put(batch.agg(F.greatest(F.max(at), F.lit(newest).cast("long")).alias("newest")), marks, batch_id)
        finally:
            batch.unpersist()

    return step
