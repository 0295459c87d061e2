"""Non-blocking retries on a stream.

Failed rows leave the main flow for a retry table with a due time and come back in
the first micro-batch after it.  Nothing is deleted from the retry table: batch N takes
the rows due after the clock of the batch before it and up to its own clock.  The clock
of a batch is stored before it is used, so a replayed batch takes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import seconds
from tidemark.operators.retry import AS_CODED
from tidemark.streaming import tables
from tidemark.streaming.sinks import BatchWriter

_CLOCK = T.StructType().add("now", T.TimestampType())
_START = datetime(1970, 1, 1, tzinfo=timezone.utc)


@dataclass(frozen=True)
class RetryTables:
    """Folders of the flow, below one root."""

    root: str

    @property
    def ok(self) -> str:
        return f"{self.root}/ok"

    @property
    def retry(self) -> str:
        return f"{self.root}/retry"

    @property
    def dead(self) -> str:
        return f"{self.root}/dead"

    @property
    def clock(self) -> str:
        return f"{self.root}/clock"


def wall_clock(_: DataFrame) -> datetime:
    return datetime.now(timezone.utc)


def _clock(spark: SparkSession, path: str, batch_id: int,
           read_clock: Callable[[], datetime]) -> tuple[datetime, datetime]:
    """Clock of the batch before and of this batch, stored on first use."""
    tables.create(spark, path, _CLOCK)
    known = tables.read(spark, path, _CLOCK)
    own = known.where(F.col(tables.BATCH) == batch_id).first()
    before = known.where(F.col(tables.BATCH) < batch_id).agg(F.max("now")).first()[0]
    last = before.astimezone(timezone.utc) if before else _START
    if own is not None:
        return last, own["now"].astimezone(timezone.utc)
    now = max(read_clock(), last)
    tables.put(spark.createDataFrame([(now,)], _CLOCK), path, batch_id)
    return last, now


def retry_flow(where: RetryTables, schema: T.StructType, failing: Column,
               delays: Sequence[int] = AS_CODED,
               clock: Callable[[DataFrame], datetime] = wall_clock,
               on_dead: BatchWriter | None = None) -> BatchWriter:
    """Split each batch, with the retries due in it, into ok, retry and dead rows.

    ``failing`` is evaluated on every attempt and may use the column ``attempt``
    (from 1).  After ``len(delays)`` failed retries a row is dead and goes to the dead
    table and to ``on_dead``.  Delays must be positive.
    """
    if not delays or min(delays) <= 0:
        raise ValueError("delays must be positive")
    waits = F.array(*[F.lit(int(d)) for d in delays])
    tried = T.StructType(list(schema.fields)).add("attempt", T.IntegerType())
    parked = T.StructType(list(tried.fields)).add("next_attempt_at", T.TimestampType()) \
        .add("due_hour", T.LongType())
    names = schema.fieldNames()

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last, now = _clock(spark, where.clock, batch_id, lambda: clock(batch))
        tables.create(spark, where.retry, parked, ("due_hour",))
        hours = F.col("due_hour").between(int(last.timestamp() // 3600),
                                          int(now.timestamp() // 3600))
        due = tables.read(spark, where.retry, parked, before=batch_id).where(
            hours & (F.col("next_attempt_at") > F.lit(last))
            & (F.col("next_attempt_at") <= F.lit(now))).select(*names, "attempt")
        work = batch.select(*names, F.lit(1).alias("attempt")).unionByName(due)
        work = work.withColumn("_failed", F.coalesce(failing, F.lit(False))).persist()
        try:
            tables.put(work.where(~F.col("_failed")).drop("_failed"), where.ok, batch_id)
            failed = work.where("_failed").drop("_failed")
            spent = F.col("attempt") > len(delays)
            next_at = F.lit(now) + seconds(F.element_at(waits, F.col("attempt")))
            again = (failed.where(~spent).withColumn("next_attempt_at", next_at)
                     .withColumn("attempt", F.col("attempt") + 1)
                     .withColumn("due_hour",
                                 F.floor(F.unix_seconds("next_attempt_at") / 3600).cast("long")))
            tables.put(again, where.retry, batch_id, partition_by=("due_hour",))
            dead = failed.where(spent)
            tables.put(dead, where.dead, batch_id)
            if on_dead is not None:
                on_dead(dead, batch_id)
        finally:
            work.unpersist()

    return step


def pending(spark: SparkSession, where: RetryTables, schema: T.StructType) -> DataFrame:
    """Parked rows that no batch has taken up yet."""
    parked = T.StructType(list(schema.fields)).add("attempt", T.IntegerType()) \
        .add("next_attempt_at", T.TimestampType()).add("due_hour", T.LongType())
    now = tables.read(spark, where.clock, _CLOCK).agg(F.max("now")).first()[0]
    return tables.read(spark, where.retry, parked).where(F.col("next_attempt_at") > F.lit(now)) \
        .select(*schema.fieldNames(), "attempt", "next_attempt_at")
