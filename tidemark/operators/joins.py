"""Time-bounded joins and membership checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import epoch_micros, seconds
from tidemark.operators.skew import (SPLIT_ROWS, flag_hot, hot_keys, hot_keys_of, running,
                                     running_max)

JOIN_SECONDS = 30
# Lower than for windows: within a key the bound is checked pair by pair.
JOIN_SPLIT_ROWS = 100_000


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  before: int = JOIN_SECONDS, after: int = JOIN_SECONDS, how: str = "inner",
                  include_end: bool = True, split_rows: int = JOIN_SPLIT_ROWS,
                  grace: str = "0 seconds") -> DataFrame:
    """Pairs with equal ``key`` and ``left_ts - before <= right_ts <= left_ts + after``.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.  Columns other
    than the key must have distinct names.  In batch, keys that are hot on either
    side are also joined on a time slot as wide as the bound, so that such a key is
    spread over tasks; every left row keeps one slot and every right row is offered
    to its own and the two neighbouring slots.  Semi and anti joins of hot keys look
    up the next right row instead, without forming pairs.  On a stream both sides get a
    watermark ``grace`` behind their newest row, and left rows without a partner come out
    once it has passed.
    """
    pair_ts, low = F.col(right_ts), F.col(left_ts) - seconds(before)
    high = F.col(left_ts) + seconds(after)
    in_time = (pair_ts >= low) & ((pair_ts <= high) if include_end else (pair_ts < high))
    right = right.withColumnRenamed(key, "_right_key")
    on = F.col(key) == F.col("_right_key")

    if left.isStreaming or right.isStreaming:
        left = left.withWatermark(left_ts, grace)
        right = right.withWatermark(right_ts, grace)
        return left.join(right, on & in_time, "left_outer" if how == "left" else how) \
                   .drop("_right_key")

    hot = hot_keys_of([left.select(key), right.select("_right_key")], split_rows)
    if hot is None:
        return left.join(right, on & in_time, how).drop("_right_key")

    if how in ("left_semi", "left_anti"):
        hot_left = flag_hot(left, [key], hot)
        hot_right = flag_hot(right, ["_right_key"], hot)
        calm = hot_left.where(~F.col("_is_hot")).drop("_is_hot").join(
            hot_right.where(~F.col("_is_hot")).drop("_is_hot"), on & in_time, how)
        return calm.unionByName(_has_next(
            hot_left.where("_is_hot").drop("_is_hot"), hot_right.where("_is_hot"),
            key, left_ts, right_ts, before, after, include_end, how == "left_semi", split_rows))

    width = max(before, after, 1) * 1_000_000

    def slot(ts: str):
        return F.floor(epoch_micros(ts) / F.lit(width)).cast("long")

    near = F.when(F.col("_is_hot"), F.array(*[slot(right_ts) + d for d in (-1, 0, 1)])) \
            .otherwise(F.array(F.lit(0).cast("long")))
    left = flag_hot(left, [key], hot).withColumn(
        "_slot", F.when(F.col("_is_hot"), slot(left_ts)).otherwise(F.lit(0).cast("long"))) \
        .drop("_is_hot")
    right = flag_hot(right, ["_right_key"], hot) \
        .withColumn("_right_slot", F.explode(near)).drop("_is_hot")
    slots = F.col("_slot") == F.col("_right_slot")
    return left.join(right, on & slots & in_time, how) \
               .drop("_right_key", "_slot", "_right_slot")


def _has_next(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
              before: int, after: int, include_end: bool, wanted: bool,
              split_rows: int) -> DataFrame:
    """Left rows for which a right row in the bound exists (or, unwanted, does not).

    Both sides are put on one time line, a left row at the start of its bound.  Read
    backwards, the latest right row seen is the next one after that start.
    """
    packed = F.struct(*left.columns)
    plain = [f.name for f in left.schema.fields if not isinstance(f.dataType, T.MapType)]
    spread = F.lit(2 ** 50)
    probes = left.select(
        F.col(key).alias("_k"), (-(epoch_micros(left_ts) - before * 1_000_000)).alias("_back"),
        (spread + F.pmod(F.xxhash64(*plain), spread)).alias("_tie"),
        packed.alias("_row"))
    marks = right.where(F.col("_right_key").isNotNull() & F.col(right_ts).isNotNull()) \
        .groupBy(F.col("_right_key").alias("_k"),
                 (-epoch_micros(right_ts)).alias("_back")).agg(F.lit(0).alias("_tie")) \
        .select("_k", "_back", F.col("_tie").cast("long").alias("_tie"),
                F.lit(None).cast(left.select(packed.alias("r")).schema["r"].dataType)
                .alias("_row"))
    line = probes.unionByName(marks)
    seen = running(line, ["_k"], ["_back", "_tie"], {
        "_next": running_max(F.when(F.col("_row").isNull(), F.col("_back")))}, split_rows)
    reach = -F.col("_back") + (before + after) * 1_000_000
    nxt = -F.col("_next")
    found = F.coalesce((nxt <= reach) if include_end else (nxt < reach), F.lit(False))
    return seen.where(F.col("_row").isNotNull() & (found if wanted else ~found)) \
        .select("_row.*")


def enrich_orders(orders: DataFrame, payments: DataFrame, how: str = "inner",
                  within: int = JOIN_SECONDS, joined_at: bool = False,
                  split_rows: int = JOIN_SPLIT_ROWS, grace: str = "0 seconds") -> DataFrame:
    """Orders with the payments made within ``within`` seconds of them.

    With ``how="left"`` an order without such a payment is PENDING and its other
    payment columns are null.
    """
    left = orders.select("order_id", "customer_id", F.col("amount").alias("order_amount"),
                         "items", F.col("status").alias("order_status"),
                         F.col("created_at").alias("order_created_at"))
    right = payments.select("order_id", "payment_id", "payment_method",
                            F.col("payment_status").alias("_payment_status"),
                            F.col("created_at").alias("payment_created_at"))
    paired = interval_join(left, right, "order_id", "order_created_at", "payment_created_at",
                           within, within, how, split_rows=split_rows, grace=grace)
    alone = F.col("payment_created_at").isNull()
    out = paired.select(
        "order_id", "customer_id", "order_amount", "items", "order_status", "order_created_at",
        "payment_id", "payment_method",
        F.when(alone, "PENDING").otherwise(F.col("_payment_status")).alias("payment_status"),
        "payment_created_at",
        F.when(alone, "LEFT_JOIN").otherwise("INNER_JOIN").alias("join_type"))
    return out.withColumn("joined_at", F.current_timestamp()) if joined_at else out


def _membership(messages: DataFrame, processed: DataFrame, key: str, how: str,
                split_rows: int) -> DataFrame:
    """Semi or anti join on the id.

    An id that fills the processed side is certain to be a member, so it is settled by
    a bounded broadcast and kept out of the shuffle; hot ids among the messages are
    left to the adaptive skew split, which these join types allow on their left side.
    """
    seen = processed.select(F.col(key).alias("_seen"))
    same = F.col(key) == F.col("_seen")
    hot = None
    if not (messages.isStreaming or processed.isStreaming):
        hot = hot_keys(seen, ["_seen"], split_rows)
    if hot is None:
        return messages.join(seen, same, how)
    certain = F.broadcast(hot.table)
    rest = seen.join(certain, F.col("_seen") == F.col("_hot_0"), "left_anti")
    others = messages.join(certain, F.col(key) == F.col("_hot_0"), "left_anti")
    if how == "left_anti":
        return others.join(rest, same, how)
    members = messages.join(certain, F.col(key) == F.col("_hot_0"), "left_semi")
    return members.unionByName(others.join(rest, same, how))


def not_yet_processed(messages: DataFrame, processed: DataFrame, key: str = "message_id",
                      split_rows: int = SPLIT_ROWS) -> DataFrame:
    return _membership(messages, processed, key, "left_anti", split_rows)


def already_processed(messages: DataFrame, processed: DataFrame, key: str = "message_id",
                      split_rows: int = SPLIT_ROWS) -> DataFrame:
    return _membership(messages, processed, key, "left_semi", split_rows)


def stage_gaps(placed: DataFrame, stage_rows: DataFrame, key: str = "message_id") -> DataFrame:
    """Placed orders that the stage has not seen."""
    return not_yet_processed(placed, stage_rows, key)


def all_stage_gaps(seen: DataFrame, stages: tuple[str, ...], first: str = "placed",
                   key: str = "message_id") -> DataFrame:
    """``key, stage`` of every stage that has not seen a message of the first stage, in one pass."""
    had = seen.where(F.col("stage").isin(first, *stages)).groupBy(key).agg(F.collect_set("stage").alias("_had"))
    missing = F.array_except(F.array(*map(F.lit, stages)), F.col("_had"))
    return had.where(F.array_contains("_had", first)).select(key, F.explode(missing).alias("stage"))


def overdue_receipts(received: DataFrame, deleted: DataFrame, visibility: int = 30,
                     key: str = "message_id", received_ts: str = "received_at",
                     deleted_ts: str = "deleted_at", split_rows: int = JOIN_SPLIT_ROWS) -> DataFrame:
    """Receipts not deleted within the visibility time, which are delivered again."""
    return interval_join(received, deleted.select(key, deleted_ts), key, received_ts, deleted_ts,
                         0, visibility, "left_anti", include_end=False, split_rows=split_rows)
