"""Pipeline health: stage counts, rates, quantiles, reconciliation, lag and alerts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import exact as sums
from tidemark.functions.columns import epoch_micros, seconds
from tidemark.operators.skew import SPLIT_ROWS, previous, running, running_sum
from tidemark.session import durable

# The stages of the order pipeline, all of which should count the same.
STAGES = ("placed", "inventory", "analytics", "email", "sms", "invoice")


def stage_counters(stage_events: DataFrame) -> DataFrame:
    return stage_events.groupBy("stage").agg(F.count(F.lit(1)).alias("events"))


def stage_throughput(stage_events: DataFrame, size: str = "1 minute", ts: str = "ts",
                     grace: str = "0 seconds") -> DataFrame:
    """Events per window and stage, straight from the events."""
    if stage_events.isStreaming:
        stage_events = stage_events.withWatermark(ts, grace)
    return (stage_events.groupBy(F.window(ts, size).alias("_w"), "stage")
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                    "stage", "events"))


def stage_reconciliation(stage_events: DataFrame, stages: tuple[str, ...] = STAGES,
                         by: tuple[str | Column, ...] = ()) -> DataFrame:
    """Totals of every stage side by side and how far each trails the first stage."""
    keys = [F.col(b) if isinstance(b, str) else b for b in by]
    totals = stage_events.groupBy(*keys).agg(
        *[F.count_if(F.col("stage") == s).alias(s) for s in stages])
    first = stages[0]
    return totals.withColumns({f"{s}_missing": F.col(first) - F.col(s) for s in stages[1:]})


def throughput_change(throughput: DataFrame, period_seconds: int = 86_400,
                      by: tuple[str, ...] = ("stage",)) -> DataFrame:
    """Each window beside the same window one period earlier; null where there was none.

    Works on aggregated windows, so a stage has at most one row per window size, and a
    range frame finds the earlier row without a self-join. Only windows of the same phase
    of the period meet in a task.
    """
    span = period_seconds * 1_000_000
    start = epoch_micros("window_start")
    w = Window.partitionBy(*by, F.pmod(start, F.lit(span))).orderBy(start).rangeBetween(-span, -span)
    return (throughput.withColumn("events_before", F.sum("events").over(w))
            .select("window_start", *by, "events", "events_before",
                    (F.col("events") / F.col("events_before")).alias("ratio")))


def counter_deltas(samples: DataFrame, series: list[str], order: list[str],
                   value: str = "value", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Increase between consecutive samples of a counter; a drop means it restarted at 0.

    The first sample of a series has no increase.
    """
    seen = running(samples, series, order, {"_before": previous(F.col(value))}, split_rows)
    step = F.when(F.col(value) < F.col("_before"), F.col(value)) \
            .otherwise(F.col(value) - F.col("_before"))
    return seen.withColumn("delta", step).drop("_before")


def counter_rate(samples: DataFrame, series: list[str], order: list[str],
                 window_seconds: int = 60, slide_seconds: int | None = None,
                 value: str = "value", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Increase, per-second and per-minute rate of a counter per window.

    Each increase belongs to the window of the later sample, so tumbling windows add up
    to the total increase.
    """
    ts = order[0]
    deltas = counter_deltas(samples, series, order, value, split_rows)
    window = F.window(ts, f"{window_seconds} seconds",
                      f"{slide_seconds or window_seconds} seconds")
    out = sums.grouped(deltas, [window.alias("_w"), *series], {"increase": F.col("delta")}) \
        .withColumn("increase", F.coalesce("increase", F.lit(0.0)))
    per_second = F.col("increase") / F.lit(float(window_seconds))
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      *series, "increase", per_second.alias("per_second"),
                      (per_second * 60.0).alias("per_minute"))


def sum_by_label(samples: DataFrame, label: str, value: str = "value",
                 labels: str = "labels", by: tuple[str, ...] = ()) -> DataFrame:
    """Exact total of a measure per label; null where there is nothing to add."""
    return sums.grouped(samples, [*by, F.col(labels)[label].alias(label)], {"total": F.col(value)})


def to_buckets(df: DataFrame, value: str, bounds: tuple[float, ...],
               by: tuple[str, ...] = ()) -> DataFrame:
    """Cumulative histogram: rows at or below each bound, ending with the +Inf bucket."""
    edges = [*bounds, math.inf]
    counts = df.groupBy(*by).agg(*[F.count_if(F.col(value) <= e).alias(f"_c{i}")
                                   for i, e in enumerate(edges)])
    rows = F.array(*[F.struct(F.lit(e).alias("le"), F.col(f"_c{i}").alias("cum_count"))
                     for i, e in enumerate(edges)])
    return counts.select(*by, F.inline(rows))


def bucket_quantiles(buckets: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99),
                     by: tuple[str, ...] = ()) -> DataFrame:
    """Quantiles by linear interpolation in cumulative ``le`` buckets.

    Counts of the same bound (several instances) are added first, which leaves one row
    per bound and group.  The lowest bucket starts at 0, or is a point if its bound is not positive; a quantile that falls into
    +Inf is the highest finite bound; an empty histogram gives null.
    """
    summed = buckets.groupBy(*by, "le").agg(F.sum("cum_count").cast("double").alias("cum"))
    w = Window.partitionBy(*by).orderBy("le")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = summed.select(
        *by, "le", "cum",
        F.coalesce(F.lag("le").over(w), F.least("le", F.lit(0.0))).alias("low"),
        F.coalesce(F.lag("cum").over(w), F.lit(0.0)).alias("cum_low"),
        F.max("cum").over(whole).alias("total"))
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    asked = edges.select("*", F.explode(ranks).alias("quantile"))
    rank = F.col("quantile") * F.col("total")
    hit = (F.col("cum") >= rank) & (F.col("total") > 0)
    inside = F.col("low") + (F.col("le") - F.col("low")) * (
        (rank - F.col("cum_low")) / (F.col("cum") - F.col("cum_low")))
    at_edge = (F.col("le") == math.inf) | (F.col("cum") == F.col("cum_low"))
    value = F.when(at_edge, F.col("low")).otherwise(inside)
    return asked.groupBy(*by, "quantile").agg(
        F.min_by(F.when(hit, value), F.when(hit, F.col("le"))).alias("value"))


def bucket_rate_quantiles(samples: DataFrame, order: list[str],
                          quantiles: tuple[float, ...] = (0.5, 0.95, 0.99),
                          by: tuple[str, ...] = (), window_seconds: int = 300,
                          slide_seconds: int | None = None, value: str = "value",
                          split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Quantiles per window from the growth of cumulative ``le`` bucket counters.

    A rate is the growth over the window's length, so both give the same quantiles. A window
    in which no bucket grew gives null.
    """
    rates = counter_rate(samples, [*by, "le"], order, window_seconds, slide_seconds, value, split_rows)
    grown = rates.select("window_start", "window_end", *by, "le", F.col("increase").alias("cum_count"))
    return bucket_quantiles(grown, quantiles, ("window_start", "window_end", *by))


def _quantile_name(q: float) -> str:
    """``p05``, ``p95``, ``p99_9``: all decimals of the percentage, so that names differ."""
    whole, _, part = f"{round(q * 100, 10):.10f}".rstrip("0").rstrip(".").partition(".")
    return f"p{whole.zfill(2)}" + (f"_{part}" if part else "")


def _picked(sketch: str, quantiles: tuple[float, ...]) -> list[Column]:
    return [F.expr(f"CASE WHEN kll_sketch_get_n_double({sketch}) > 0 THEN kll_sketch_get_quantile_double({sketch}, {float(q)}D) END")
            .alias(_quantile_name(q)) for q in quantiles]


def duration_sketches(df: DataFrame, value: str, size: str = "1 day", by: tuple[str, ...] = (), ts: str = "ts",
                      sketch_size: int = 800, grace: str = "0 seconds") -> DataFrame:
    """Per window the count, exact total, maximum and a quantile sketch, to be kept and merged later.

    The sketch is a binary of bounded size: up to ``sketch_size`` values it holds them all, and ranks
    are exact; beyond that a rank is off by about 2.3 / sketch_size^0.9 of the count (0.6 % at 800, 99 % confidence).
    Values that are NaN are in no sketch.
    """
    if df.isStreaming:
        df = df.withWatermark(ts, grace)
    number = F.col(value)
    out = sums.grouped(df, [F.window(ts, size).alias("_w"), *by], {"total": number}, counts={"count": number},
                       tops={"max": number}, sketches={"sketch": number}, sketch_size=sketch_size)
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *by, "count", "total", "max", "sketch")


def summary_of_sketches(sketches: DataFrame, by: tuple[str, ...] = (), quantiles: tuple[float, ...] = (0.5, 0.95, 0.99),
                        sketch_size: int = 800) -> DataFrame:
    """Summary of a longer span from stored windows, by merging their sketches.

    The error of a rank is that of one sketch over all rows. Totals add the windows' totals, each rounded once.
    """
    grouped = sums.grouped(sketches, by, {"total": F.col("total")}, tops={"max": F.col("max")})
    merged = sketches.groupBy(*by).agg(F.sum("count").alias("count"), F.expr(f"kll_merge_agg_double(sketch, {sketch_size})").alias("_q"))
    keys = [F.col(b).alias(f"_g{i}") for i, b in enumerate(by)]
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_g{i}"))
    return merged.join(grouped.select(*keys, "total", "max"), same).select(*by, "count", "total", "max", *_picked("_q", quantiles))


def duration_summary(df: DataFrame, value: str, by: tuple[str, ...] = (),
                     quantiles: tuple[float, ...] = (0.5, 0.95, 0.99),
                     exact: bool = False, split_rows: int = SPLIT_ROWS, sketch_size: int = 800) -> DataFrame:
    """Count, total, maximum and quantiles of durations.

    Quantiles come from a mergeable sketch, as in ``duration_sketches``; with ``exact`` from the ranks of the
    distinct values, counted before they are ranked so that no group is collected; everything
    else comes from these counts, so the rows are read once.  Totals are exact sums.  A group
    without values keeps its row.
    """
    names = [_quantile_name(q) for q in quantiles]
    if not exact:
        number = F.col(value)
        out = sums.grouped(df, by, {"total": number}, counts={"count": number}, tops={"max": number}, sketches={"_q": number},
                           sketch_size=sketch_size)
        return out.select(*by, "count", "total", "max", *_picked("_q", quantiles))

    if not by:
        df, by = df.withColumn("_all", F.lit(0)), ("_all",)
    freq = durable(df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n")))
    ranked = running(freq.where(F.col(value).isNotNull()), list(by), [value], {"_upto": running_sum(F.col("_n"))}, split_rows)
    totals = sums.grouped(freq, by, {"total": F.col(value)}, counts={"count": F.col(value)}, tops={"max": F.col(value)},
                          weight=F.col("_n"))
    keyed = totals.select(*[F.col(b).alias(f"_g_{i}") for i, b in enumerate(by)],
                          "count", "total", "max")
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_g_{i}"))
    ranks = ranked.select(*by, value, "_n", "_upto")
    joined = ranks.join(keyed, same, "right").select(
        *[F.col(f"_g_{i}").alias(b) for i, b in enumerate(by)], value, "_n", "_upto", "count", "total", "max")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank),
                            F.col(value)))

    picks = []
    for q, name in zip(quantiles, names):
        spot = F.lit(float(q)) * (F.col("count") - 1)
        picks += [at(F.floor(spot)).alias(f"_lo_{name}"), at(F.ceil(spot)).alias(f"_hi_{name}"),
                  F.max(spot - F.floor(spot)).alias(f"_f_{name}")]
    out = joined.groupBy(*by).agg(F.max("count").alias("count"), F.max("total").alias("total"),
                                  F.max("max").alias("max"), *picks)
    blended = [(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}"))
               .alias(n) for n in names]
    return out.select(*[b for b in by if b != "_all"], "count", "total", "max", *blended)


def consumer_lag(log: DataFrame, commits: DataFrame) -> DataFrame:
    """Messages not yet committed per partition; without a commit, all that ever arrived.

    A committed partition whose rows have gone ends where its commit is.
    """
    ends = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    return (ends.join(commits.select("topic", "partition", "next_offset"),
                      ["topic", "partition"], "full")
            .withColumn("end_offset", F.coalesce("end_offset", "next_offset"))
            .select("topic", "partition", "end_offset", "next_offset",
                    (F.col("end_offset") - F.coalesce("next_offset", F.lit(0))).alias("lag")))


def sustained_alerts(rates: DataFrame, series: list[str], threshold: float, slide_seconds: int,
                     hold_seconds: int = 120, rate: str = "per_second",
                     block_rows: int = SPLIT_ROWS) -> DataFrame:
    """Stretches of consecutive windows over the threshold that last at least the hold time.

    Works on aggregated windows, so a series has at most one row per slide interval. Time is cut
    into blocks of ``block_rows`` intervals that are searched apart; then the stretches at the
    edges of blocks, two a block where windows lie on one grid, are put together per series.
    """
    slide = slide_seconds * 1_000_000
    span = slide * block_rows

    def block(at: Column) -> Column:
        return at - F.pmod(at, F.lit(span))

    at = epoch_micros("window_end")
    over = rates.where((F.col(rate) > threshold) & F.col("window_end").isNotNull()) \
        .select(*series, "window_end", F.col(rate).alias("_rate"), at.alias("_at")).withColumn("_block", block(F.col("_at")))
    within = _islands(over, [*series, "_block"], F.col("_at"), F.col("_at"), slide)
    parts = within.groupBy(*series, "_block", "_island").agg(*_stretch(F.col("window_end"), F.col("window_end"), F.col("_rate"), F.lit(1)),
                                                             F.min("_at").alias("_from"), F.max("_at").alias("_to"))
    edge = (block(F.col("_from") - slide) < F.col("_block")) | (block(F.col("_to") + slide) > F.col("_block"))
    marked = parts.withColumn("_edge", edge)
    whole = ["alert_start", "alert_end", "peak_rate", "windows"]
    # A stretch inside its block is a group of its own, and one window function serves both kinds.
    apart = F.when(F.col("_edge"), F.lit(None)).otherwise(F.struct("_block", "_island"))
    joined = _islands(marked.withColumn("_apart", apart).drop("_island"), [*series, "_apart"], F.col("_from"), F.col("_to"), slide)
    found = joined.groupBy(*series, "_apart", "_island").agg(
        *_stretch(F.col("alert_start"), F.col("alert_end"), F.col("peak_rate"), F.col("windows")))
    held = F.col("alert_end") >= F.col("alert_start") + seconds(hold_seconds)
    return found.where(held).select(*series, *whole)


def _islands(df: DataFrame, keys: list[str], first: Column, last: Column, slide: int) -> DataFrame:
    """Number the runs of rows that begin one slide after the end of the row before."""
    w = Window.partitionBy(*keys).orderBy(first)
    fresh = F.when(F.lag(last).over(w) == first - slide, 0).otherwise(1)
    return df.withColumn("_new", fresh).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def _stretch(start: Column, end: Column, rate: Column, windows: Column) -> list[Column]:
    return [F.min(start).alias("alert_start"), F.max(end).alias("alert_end"), F.max(rate).alias("peak_rate"),
            F.sum(windows).alias("windows")]
