"""Duplicate elimination by message id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import exact
from tidemark.functions.columns import dedup_id, epoch_micros
from tidemark.operators.skew import (BROADCAST_ROWS, SPLIT_ROWS, chunk_hot, chunked, previous, running,
                                     running_chunked, running_count, running_max,
                                     running_plain, running_sum, same_keys)
from tidemark.session import durable

DAY_SECONDS = 86_400
FIFO_SECONDS = 300


def first_deliveries(deliveries: DataFrame, order: list[str],
                     key: str = "message_id") -> DataFrame:
    """The first delivery of every id, however often it was repeated.

    Batch.  The rank filter is applied before the shuffle as well as after it, so the
    copies of one id collapse to one row per map task.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return (deliveries.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def with_delivery_ordinal(deliveries: DataFrame, order: list[str], key: str = "message_id",
                          split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Number the deliveries of every id: 1 is processed, later ones are duplicates."""
    return running(deliveries, [key], order, {"delivery_ordinal": running_count()}, split_rows)


def duplicate_deliveries(deliveries: DataFrame, order: list[str], key: str = "message_id",
                         split_rows: int = SPLIT_ROWS) -> DataFrame:
    return with_delivery_ordinal(deliveries, order, key, split_rows) \
        .where(F.col("delivery_ordinal") > 1)


def accepted_within_ttl(deliveries: DataFrame, order: list[str], ttl: float = DAY_SECONDS,
                        key: str = "message_id", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Deliveries accepted when an id is remembered for ``ttl`` seconds.

    The time counts from the accepted delivery and a duplicate does not extend it; a
    delivery exactly at expiry is accepted.  ``order`` is the timestamp and a number
    that breaks ties.  A delivery without a time stamp can neither expire nor be placed
    and is never accepted; rows without an id share one.  Batch, exact.

    A delivery at least ``ttl`` after the one before it is always accepted and opens a
    stretch; those less than ``ttl`` after the opening are always rejected.  Both are
    settled by window functions.  Only what is left, later deliveries of a stretch that
    outlasts ``ttl``, depends on the deliveries accepted in between.
    """
    span = round(ttl * 1_000_000)
    deliveries = deliveries.where(F.col(order[0]).isNotNull())
    found = chunked(deliveries, [key], order, split_rows)
    if found is None:
        return _accepted_plain(deliveries, key, order, span)
    cold = found.rows.where(F.col("_chunk") < 0).drop("_chunk")
    hot = found.rows.where(F.col("_chunk") >= 0)
    return _accepted_plain(cold, key, order, span).unionByName(
        _accepted_hot(hot, found.bound, key, order, span, split_rows, found.tasks))


def _outputs(when: Column, span: int) -> tuple[Column, dict, dict]:
    opens = F.col("_before").isNull() | (when >= F.col("_before") + span)
    return opens, {"_before": previous(when)}, {"_opened": running_max(F.when(opens, when))}


def _unsettled(seen: DataFrame, columns: list[str], opens: Column, when: Column,
               span: int) -> DataFrame:
    return seen.where(~opens & (when >= F.col("_opened") + span)) \
        .select(*columns, "_opened", when.alias("_t"))


def _accepted_plain(rows: DataFrame, key: str, order: list[str], span: int) -> DataFrame:
    columns, when = rows.columns, epoch_micros(order[0])
    opens, before, opened = _outputs(when, span)
    seen = running_plain(running_plain(rows, [key], order, before), [key], order, opened)
    late = _scan(_unsettled(seen, columns, opens, when, span), key, order, span)
    return seen.where(opens).select(*columns).unionByName(late.select(*columns))


def _accepted_hot(rows: DataFrame, bound: int, key: str, order: list[str], span: int,
                  split_rows: int, tasks: int) -> DataFrame:
    """The same for ids that are cut into chunks; every stage is written down once."""
    columns, when = [c for c in rows.columns if c != "_chunk"], epoch_micros(order[0])
    opens, before, opened = _outputs(when, span)
    seen = durable(running_chunked(rows, bound, [key], order, before, tasks))
    seen = durable(running_chunked(seen, bound, [key], order, opened, tasks))
    accepted = seen.where(opens).select(*columns)
    unsettled = durable(_unsettled(seen, columns, opens, when, span))
    stretch = [key, "_opened"]
    long = chunk_hot(unsettled, stretch, order, split_rows)
    if long is None:
        return accepted.unionByName(_scan(unsettled, key, order, span).select(*columns))
    short = _scan(long[0].where(F.col("_chunk") < 0).drop("_chunk"), key, order, span)
    rest = long[0].where(F.col("_chunk") >= 0).drop("_chunk")
    return accepted.unionByName(short.select(*columns)).unionByName(
        _follow(rest, stretch, order, span, split_rows).select(*columns))


def _scan(rows: DataFrame, key: str, order: list[str], span: int) -> DataFrame:
    """Per stretch, accept in order what is not before the last expiry.

    Rows stream through in Arrow batches, so a stretch need not fit in memory.
    """
    def accept(batches):
        import pyarrow as pa

        stretch, expiry = None, None
        for batch in batches:
            keep = []
            for k, o, t in zip(*[batch.column(n).to_pylist() for n in (key, "_opened", "_t")]):
                if stretch != (k, o):
                    stretch, expiry = (k, o), t
                keep.append(t >= expiry)
                if t >= expiry:
                    expiry = t + span
            yield batch.filter(pa.array(keep, pa.bool_()))

    laid = rows.repartition(key, "_opened").sortWithinPartitions(key, "_opened", *order)
    return laid.mapInArrow(accept, rows.schema)


def _follow(rows: DataFrame, stretch: list[str], order: list[str], span: int,
            split_rows: int) -> DataFrame:
    """Accepted rows of stretches too long for one task, by pointer doubling.

    Every row points to the first row that may follow it, ``span`` later.  The first
    row of a stretch is accepted; each round extends the accepted rows along pointers
    that then double in length, so the rounds grow with the logarithm of the number
    of accepted rows.
    """
    placed = durable(running(rows, stretch, order, {"_pos": running_count()}, split_rows))
    same = [F.col(c).alias(f"_g{i}") for i, c in enumerate(stretch)]
    group = [f"_g{i}" for i in range(len(stretch))]
    real = placed.select(*same, F.col("_t").alias("_at"), (F.col("_pos") * 2 + 1).alias("_tie"),
                         "_pos", F.lit(1).alias("_real"))
    probe = placed.select(*same, (F.col("_t") + span).alias("_at"), (F.col("_pos") * 2)
                          .alias("_tie"), "_pos", F.lit(0).alias("_real"))
    # Positions follow time, but a probe shares its instant with rows of any position:
    # it counts the rows strictly before that instant, so probes sort first.
    both = real.unionByName(probe).withColumn("_slot", F.col("_at") * 2 + F.col("_real"))
    counted = running(both, group, ["_slot", "_tie"],
                      {"_earlier": running_sum(F.col("_real"))}, split_rows)
    last = placed.groupBy(*stretch).agg(F.max("_pos").alias("_last")) \
        .select(*[F.col(c).alias(f"_l{i}") for i, c in enumerate(stretch)], "_last")
    jump = durable(counted.where(F.col("_real") == 0)
                   .join(F.broadcast(last) if _few(last) else last, same_keys(group, "_l"))
                   .where(F.col("_earlier") < F.col("_last"))
                   .select(*group, "_pos", (F.col("_earlier") + 1).alias("_to")))
    marked = durable(placed.where(F.col("_pos") == 1).select(*same, "_pos"))
    while True:
        ahead = jump.select(*[F.col(g).alias(f"_a{i}") for i, g in enumerate(group)],
                            F.col("_pos").alias("_ap"), F.col("_to").alias("_at"))
        reached = durable(marked.join(ahead, same_keys(group, "_a") & (
            F.col("_pos") == F.col("_ap"))).select(*group, F.col("_at").alias("_pos")))
        if reached.limit(1).count() == 0:
            break
        marked = marked.unionByName(reached)
        jump = durable(jump.join(ahead, same_keys(group, "_a") & (F.col("_to") == F.col("_ap")))
                       .select(*group, "_pos", F.col("_at").alias("_to")))
    found = marked.select(*[F.col(g).alias(f"_m{i}") for i, g in enumerate(group)],
                          F.col("_pos").alias("_mp"))
    return placed.join(found, same_keys(stretch, "_m") & (F.col("_pos") == F.col("_mp")),
                       "left_semi")


def _few(table: DataFrame) -> bool:
    return table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def fifo_accepted(messages: DataFrame, order: list[str], body: str = "body",
                  explicit_id: str | None = None, window: float = FIFO_SECONDS,
                  split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Messages let through by a five-minute queue: explicit id first, else content hash."""
    keyed = messages.withColumn("dedup_id", dedup_id(explicit_id, body))
    return accepted_within_ttl(keyed, order, window, "dedup_id", split_rows)


def double_charges(deliveries: DataFrame, order: list[str], key: str = "message_id",
                   customer: str = "customer_id", amount: str = "amount") -> DataFrame:
    """Per customer: charged without dedup, charged with it, and the difference, each an exact sum."""
    once = first_deliveries(deliveries.select(key, customer, amount, *order), order, key)
    both = deliveries.select(customer, amount, F.lit(False).alias("_once")) \
        .unionByName(once.select(customer, amount, F.lit(True).alias("_once")))
    paid, first = F.col(amount).cast("double"), F.col("_once")
    out = exact.grouped(both, [customer], {
        "naive_total": F.when(~first, paid), "idempotent_total": F.when(first, paid),
        "overcharge": F.when(first, -paid).otherwise(paid)})
    none = F.lit(0.0)
    return out.select(customer, *[F.coalesce(n, none).alias(n) for n in ("naive_total", "idempotent_total", "overcharge")])
