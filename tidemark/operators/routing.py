"""Message routing, key partitioning and order checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import topic_regex, topic_subject
from tidemark.operators.bindings import BROADCAST_ROWS, by_headers, by_pattern, deliver
from tidemark.operators.skew import SPLIT_ROWS, previous, running, running_count

#: Binding tables of up to so many rows become literals; the answer is the same either way.
INLINE_BINDINGS = 200


def _wildcard(binding_key: str) -> bool:
    return bool({"*", "#"} & set(binding_key.split(".")))


def _usable(bindings: DataFrame) -> DataFrame:
    """Bindings that can match: those with a queue, and with a key unless they fan out."""
    fan = F.col("exchange_type") == "FANOUT"
    return (bindings.select("exchange", "exchange_type", "binding_key", "queue")
            .where(F.col("queue").isNotNull() & (fan | F.col("binding_key").isNotNull()))
            .withColumn("_regex", topic_regex("binding_key")))


def _inline_match(b, subject: Column) -> Column:
    """Condition under which a message reaches the queue of one (collected) binding."""
    kind = b["exchange_type"]
    here = F.col("exchange") == b["exchange"]
    if kind == "FANOUT":
        return here
    if kind == "TOPIC" and _wildcard(b["binding_key"]):
        return here & subject.rlike(b["_regex"])
    return here & (F.col("routing_key") == F.lit(b["binding_key"]))


def route(messages: DataFrame, bindings: DataFrame, keep_unroutable: bool = False,
          inline_limit: int = INLINE_BINDINGS,
          broadcast_limit: int = BROADCAST_ROWS) -> DataFrame:
    """One row per message and queue it reaches; ``queue`` is null for no queue if kept.

    Messages carry ``exchange`` and ``routing_key``; bindings ``exchange``,
    ``exchange_type``, ``binding_key``, ``queue``.  A queue gets one copy even if
    several bindings match.  A null routing or binding key matches nothing but a fan-out; a
    binding without a queue delivers nothing.  A small binding table becomes literals in a
    projection; any other is a trie that messages walk by joins, with equal results.
    """
    prepared = _usable(bindings)
    found = prepared.limit(inline_limit + 1).collect()
    if len(found) <= inline_limit:
        return _route_inline(messages, found, keep_unroutable)
    return _route_joined(messages, prepared, keep_unroutable, broadcast_limit)


def _route_inline(messages: DataFrame, found: list, keep_unroutable: bool) -> DataFrame:
    subject = topic_subject("routing_key")
    by_queue: dict[str, list[Column]] = {}
    for b in found:
        by_queue.setdefault(b["queue"], []).append(_inline_match(b, subject))
    hits = [F.when(reduce(lambda x, y: x | y, conds), F.lit(q))
            for q, conds in sorted(by_queue.items())]
    return _burst(messages, hits, keep_unroutable)


def _burst(messages: DataFrame, hits: list[Column], keep_unroutable: bool = False) -> DataFrame:
    """One row per non-null hit."""
    queues = F.array(*hits) if hits else F.array().cast("array<string>")
    if keep_unroutable:
        return messages.select("*", F.explode_outer(F.array_compact(queues)).alias("queue"))
    return messages.select("*", F.explode(queues).alias("queue")).where(F.col("queue").isNotNull())


def _route_joined(messages: DataFrame, prepared: DataFrame, keep_unroutable: bool,
                  broadcast_limit: int) -> DataFrame:
    """Walk the trie of binding keys: a batch once per distinct routing key, a stream with each message."""
    if messages.isStreaming:
        found = by_pattern(messages.withColumn("_uid", F.uuid()), prepared, keep_unroutable, broadcast_limit)
        return deliver(found, messages.schema)
    keys = messages.select("exchange", "routing_key").distinct() \
        .withColumn("_uid", F.coalesce("routing_key", F.lit("")))
    queues = by_pattern(keys, prepared, False, broadcast_limit) \
        .select(F.col("exchange").alias("_re"), F.col("routing_key").alias("_rk"), "queue").distinct()
    on = (F.col("exchange") == F.col("_re")) & F.col("routing_key").eqNullSafe(F.col("_rk"))
    return messages.join(queues, on, "left" if keep_unroutable else "inner").drop("_re", "_rk")


def unroutable(messages: DataFrame, bindings: DataFrame) -> DataFrame:
    """Messages that no queue receives, found in the same pass that routes them."""
    return route(messages, bindings, keep_unroutable=True) \
        .where(F.col("queue").isNull()).drop("queue")


def route_by_headers(messages: DataFrame, bindings: DataFrame,
                     inline_limit: int = INLINE_BINDINGS,
                     broadcast_limit: int = BROADCAST_ROWS) -> DataFrame:
    """Route on message attributes: a binding asks for ``all`` or ``any`` of its headers.

    ``match`` may be written in either case; anything but "any" means all.  A binding without
    a queue or a header map delivers nothing; a null header value matches nothing.
    """
    asks_any = F.coalesce(F.lower("match") == "any", F.lit(False))
    usable = bindings.where("queue IS NOT NULL AND headers IS NOT NULL") \
        .select("exchange", "headers", asks_any.alias("_any"), "queue")
    found = usable.limit(inline_limit + 1).collect()
    if len(found) > inline_limit:
        return _route_headers_joined(messages, usable, broadcast_limit)
    by_queue: dict[str, list[Column]] = {}
    for b in found:
        tests = [F.coalesce(F.col("headers")[k] == v, F.lit(False))
                 for k, v in sorted(b["headers"].items())]
        cond = reduce(lambda x, y: x | y, tests, F.lit(False)) if b["_any"] \
            else reduce(lambda x, y: x & y, tests, F.lit(True))
        by_queue.setdefault(b["queue"], []).append((F.col("exchange") == b["exchange"]) & cond)
    hits = [F.when(reduce(lambda x, y: x | y, conds), F.lit(q))
            for q, conds in sorted(by_queue.items())]
    return _burst(messages, hits)


def _route_headers_joined(messages: DataFrame, usable: DataFrame, broadcast_limit: int) -> DataFrame:
    """Look up postings of headers: a batch once per distinct set of headers, a stream with each message."""
    if messages.isStreaming:
        return deliver(by_headers(messages.withColumn("_uid", F.uuid()), usable, broadcast_limit), messages.schema)
    own = F.array_sort(F.coalesce(F.map_entries("headers"), F.map_entries(F.create_map().cast("map<string,string>"))))
    sets = messages.select("exchange", own.alias("_set")).distinct() \
        .select("exchange", "_set", F.map_from_entries("_set").alias("headers"), F.xxhash64("_set").alias("_uid"))
    queues = by_headers(sets, usable, broadcast_limit) \
        .select(F.col("exchange").alias("_he"), F.col("_set").alias("_hs"), "queue").distinct()
    return messages.withColumn("_set", own).join(queues, (F.col("exchange") == F.col("_he")) & (F.col("_set") == F.col("_hs"))) \
        .select(*messages.columns, "queue")


# --- keys and partitions ---------------------------------------------------------------

def hash_partition(key: str, partitions: int) -> Column:
    """Log partition of a key: equal keys share one."""
    return F.pmod(F.hash(key), F.lit(partitions)).cast("int")


def explicit_partition(df: DataFrame, key: str, mapping: dict[str, int],
                       partitions: int) -> DataFrame:
    """Add ``partition``: the mapped one, else by hash.  The map is a driver-side dict."""
    fixed = F.create_map(*[F.lit(x) for kv in sorted(mapping.items()) for x in kv]) \
        if mapping else None
    hashed = hash_partition(key, partitions)
    return df.withColumn("partition", F.coalesce(F.try_element_at(fixed, F.col(key)), hashed)
                         if mapping else hashed)


def partition_report(log: DataFrame, key: str, partition: str = "partition") -> DataFrame:
    return log.groupBy(partition).agg(F.count(F.lit(1)).alias("events"),
                                      F.count_distinct(key).alias("distinct_keys"))


def keys_per_partition(log: DataFrame, key: str, partition: str = "partition") -> DataFrame:
    return log.groupBy(key, partition).agg(F.count(F.lit(1)).alias("events"))


def ordered_by_key(df: DataFrame, key: str, order: list[str], partitions: int,
                   strict: bool = False) -> DataFrame:
    """Lay rows out so that each key is contiguous and in order.

    By default the ranges follow (key, order), so a hot key continues in the next
    partition.  ``strict`` keeps every key in one partition, as a log would.
    """
    if strict:
        return df.repartition(partitions, key).sortWithinPartitions(key, *order)
    return df.repartitionByRange(partitions, key, *order).sortWithinPartitions(key, *order)


def group_sequence(messages: DataFrame, group: str, order: list[str],
                   split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Number the messages of every group in sending order."""
    return running(messages, [group], order, {"sequence": running_count()}, split_rows)


def order_violations(deliveries: DataFrame, key: str, delivered: list[str], sequence: str,
                     split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Deliveries whose predecessor within the key was sent later."""
    seen = running(deliveries, [key], delivered, {"previous_sequence": previous(F.col(sequence))},
                   split_rows)
    return seen.where(F.col(sequence) < F.col("previous_sequence"))
