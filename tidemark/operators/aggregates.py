"""Keyed counts, windowed revenue and their changelogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import exact
from tidemark.functions.columns import epoch_millis
from tidemark.operators.skew import SPLIT_ROWS, running, running_count, running_sum


def orders_per_customer(orders: DataFrame, key: str = "customer_id") -> DataFrame:
    """Orders of any state per customer; rows without a customer are skipped."""
    return (orders.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("order_count")))


def windowed(events: DataFrame, aggregates: dict[str, Column], size: str = "1 minute",
             slide: str | None = None, by: tuple[str, ...] = (), ts: str = "created_at",
             grace: str = "0 seconds") -> DataFrame:
    """Any aggregate expressions per time window, and per ``by`` within it.

    Without ``slide`` the windows tumble.  There is no artificial grouping key, so
    partial aggregation spreads even a single window over all tasks.  On a stream
    rows later than ``grace`` are dropped; write in ``update`` mode for a row per
    change or in ``append`` mode for closed windows only.
    """
    if events.isStreaming:
        events = events.withWatermark(ts, grace)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (events.groupBy(window.alias("window"), *by)
            .agg(*[a.alias(n) for n, a in aggregates.items()])
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), *by, *aggregates))


def revenue_windows(orders: DataFrame, size: str = "1 minute", slide: str | None = None,
                    by: tuple[str, ...] = (), statuses: tuple[str, ...] | None = None,
                    ts: str = "created_at", grace: str = "0 seconds") -> DataFrame:
    """Revenue and order count per window, over all states unless told otherwise.

    Revenue is the exact sum of the amounts, 0.0 where none has one.
    """
    if statuses is not None:
        orders = orders.where(F.col("status").isin(*statuses))
    if orders.isStreaming:
        orders = orders.withWatermark(ts, grace)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    sums = exact.grouped(orders, [window.alias("window"), *by], {"total_revenue": F.col("amount")}, "order_count")
    return sums.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by,
                       F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"), "order_count")


def revenue_records(windows: DataFrame) -> DataFrame:
    """Window rows in the published form: start as text key, bounds in epoch millis."""
    return windows.select(epoch_millis("window_start").cast("string").alias("key"),
                          epoch_millis("window_start").alias("window_start"),
                          epoch_millis("window_end").alias("window_end"),
                          "total_revenue", "order_count")


def running_order_count(orders: DataFrame, order: list[str], key: str = "customer_id",
                        split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Changelog of the keyed count: every order with its customer's new total."""
    return running(orders.where(F.col(key).isNotNull()), [key], order,
                   {"order_count": running_count()}, split_rows)


def running_window_revenue(orders: DataFrame, order: list[str], size: str = "1 minute",
                           ts: str = "created_at", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Changelog of the windowed revenue: every order with the running total of its window."""
    placed = exact.RunningParts(
        orders.withColumn("window_start", F.window(ts, size).getField("start")), F.col("amount"))
    out = running(placed.rows, ["window_start"], order,
                  {**{name: running_sum(part) for name, part in placed.sums().items()},
                   "running_orders": running_count()}, split_rows)
    return placed.total(out, "_revenue").select(
        *orders.columns, "window_start", F.coalesce("_revenue", F.lit(0.0)).alias("running_revenue"), "running_orders")


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest row of every key.

    In batch the rank filter is applied before the shuffle as well as after it, so a hot key
    sends one row per map task; a stream keeps one row per key in state.
    """
    if not df.isStreaming:
        newest_first = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
        return df.withColumn("_rn", F.row_number().over(newest_first)).where(F.col("_rn") == 1).drop("_rn").select(key, *[c for c in df.columns if c != key])
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(newest).select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def lookup_counts(requested: DataFrame, counts: DataFrame, key: str = "customer_id") -> DataFrame:
    """Counts of the requested keys, zero for a key that was never seen."""
    return (requested.select(key).join(counts, key, "left")
            .select(key, F.coalesce("order_count", F.lit(0).cast("long")).alias("order_count")))


def unique_messages(df: DataFrame, key: str = "message_id") -> DataFrame:
    return df.agg(F.count_distinct(key).alias("unique_messages"))


def average_over_time(samples: DataFrame, value: str = "value", ts: str = "ts",
                      size: str = "5 minutes", slide: str | None = None,
                      by: tuple[str | Column, ...] = (), grace: str = "0 seconds") -> DataFrame:
    """Mean of a gauge per window: the exact sum over the count; null without samples.

    NaN where a sample is NaN or infinities of both signs meet, infinite where one is. On a stream
    rows later than ``grace`` are dropped.
    """
    if samples.isStreaming:
        samples = samples.withWatermark(ts, grace)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    keys = [F.col(b) if isinstance(b, str) else b for b in by]
    sums = exact.grouped(samples, [window.alias("_w"), *keys], {"_total": F.col(value)}, counts={"_n": F.col(value)})
    return (sums.withColumns({"average": F.col("_total") / F.when(F.col("_n") > 0, F.col("_n")),
                              "window_start": F.col("_w.start"), "window_end": F.col("_w.end")})
            .drop("_w", "_total", "_n"))
