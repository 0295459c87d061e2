"""Retry ladders and dead letters as tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import seconds

# Delays before each further attempt, in seconds.
AS_CODED = (10, 10, 10)
AS_DOCUMENTED = (10, 30, 60)
INVENTORY = (5, 15, 30)


def retry_schedule(messages: DataFrame, failing: Column, delays: Sequence[int] = AS_CODED,
                   ts: str = "created_at") -> DataFrame:
    """One row per attempt: ``OK`` for a sound message, else ``RETRY`` … and at last ``DEAD``.

    ``failing`` says which messages fail every attempt; null counts as sound.
    """
    offsets = [0, *accumulate(delays)]
    fails = F.coalesce(failing, F.lit(False))
    times = F.when(fails, F.array(*[F.lit(o) for o in offsets])).otherwise(F.array(F.lit(0)))
    rows = messages.select("*", fails.alias("_fails"),
                           F.posexplode(times).alias("_step", "_after"))
    state = (F.when(~F.col("_fails"), "OK")
             .when(F.col("_step") == len(offsets) - 1, "DEAD").otherwise("RETRY"))
    return rows.select(*messages.columns, (F.col("_step") + 1).alias("attempt"),
                       (F.col(ts) + seconds(F.col("_after"))).alias("attempt_at"),
                       state.alias("state"))


def body_counted(messages: DataFrame, failing: Column, max_attempts: int = 3,
                 delay: int = 2, ts: str = "created_at",
                 retry_count: str | None = None) -> DataFrame:
    """Outcome per message when the attempt number travels in the message body.

    A failing message is processed until its count plus one reaches ``max_attempts``
    and is then stored dead with the count it carried.
    """
    start = F.col(retry_count) if retry_count else F.lit(0)
    fails = F.coalesce(failing, F.lit(False))
    final = F.when(fails, F.greatest(start, F.lit(max_attempts - 1))).otherwise(start)
    rest = [c for c in messages.columns if c != retry_count]
    return messages.select(*rest, final.cast("int").alias("retry_count"),
                           (final - start + 1).cast("int").alias("attempts"),
                           (F.col(ts) + seconds((final - start) * delay)).alias("finished_at"),
                           F.when(fails, "DEAD").otherwise("OK").alias("state"))


def dead_letters(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("state") == "DEAD")


def dead_letter_summary(outcomes: DataFrame, attempts: str = "attempts") -> DataFrame:
    return dead_letters(outcomes).groupBy(attempts) \
        .agg(F.count(F.lit(1)).alias("dead_messages"))


def replay(dead: DataFrame, approved: Column, resumed_at: Column | None = None) -> DataFrame:
    """Reviewed dead letters as fresh main-flow messages: attempt and count start over."""
    out = dead.where(approved)
    for name in ("attempts", "attempt", "finished_at", "attempt_at", "state"):
        if name in out.columns:
            out = out.drop(name)
    if "retry_count" in out.columns:
        out = out.withColumn("retry_count", F.lit(0))
    return out.withColumn("created_at", resumed_at) if resumed_at is not None else out
