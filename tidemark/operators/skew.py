"""Per-key ordered computations that survive a key holding a large share of all rows.

A plain ``Window.partitionBy(key)`` sends one key to one task.  Here keys above
``split_rows`` are cut into chunks that follow the row order; each chunk is scanned on
its own, and a small table of per-chunk totals carries the state from chunk to chunk.
Keys below the limit take the plain window.  Batch only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import epoch_micros

SPLIT_ROWS = 2_000_000
#: Rows that a task sorts, on average, once keys are cut: partitions are numbered by rows, since sorted
#: columns compress so well that partitions sized by shuffled bytes hold many times more.
TASK_ROWS = 500_000
MAX_HOT_KEYS = 50_000
BROADCAST_ROWS = 500_000
_SAMPLED_HITS = 1_000


@dataclass(frozen=True)
class HotKeys:
    """Keys with more than the allowed rows; never more than ``MAX_HOT_KEYS`` of them."""

    table: DataFrame
    count: int
    rows: int
    all_rows: int


def hot_keys(df: DataFrame, keys: list[str], split_rows: int = SPLIT_ROWS) -> HotKeys | None:
    """Keys that hold more than about ``split_rows`` rows, or None."""
    return hot_keys_of([df.select(*keys)], split_rows)


def hot_keys_of(sides: list[DataFrame], split_rows: int = SPLIT_ROWS) -> HotKeys | None:
    """Keys that are hot in at least one of several tables with the same key columns.

    Counts a seeded sample of the keys in one job, so the check shuffles a thousandth
    of the keys at most.  It only steers the plan: a key that is missed or added by
    chance changes how rows are grouped, never the result.  Beyond ``MAX_HOT_KEYS`` the
    hottest are returned.
    """
    fraction = min(1.0, _SAMPLED_HITS / split_rows)
    wanted = split_rows * fraction * (1.0 if fraction == 1.0 else 0.5)
    width = len(sides[0].columns)
    names = [f"_hot_{i}" for i in range(width)]
    picked = [side.toDF(*names).withColumn("_side", F.lit(i)) for i, side in enumerate(sides)]
    if fraction < 1.0:
        picked = [p.sample(fraction, seed=7) for p in picked]
    counts = reduce(DataFrame.union, picked).groupBy(*names, "_side") \
        .agg(F.count(F.lit(1)).alias("_n"))
    sampled = Observation()
    found = counts.observe(sampled, F.sum("_n").alias("rows")).where(F.col("_n") > wanted) \
        .orderBy(F.desc("_n")).limit(MAX_HOT_KEYS).collect()
    if not found:
        return None
    rows = {tuple(r[n] for n in names) for r in found}
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in
                           zip(names, sides[0].schema.fields)])
    table = sides[0].sparkSession.createDataFrame(list(rows), schema)
    return HotKeys(table, len(rows), int(sum(r["_n"] for r in found) / fraction),
                   int(sampled.get["rows"] / fraction))


def same_keys(keys: list[str], prefix: str) -> Column:
    return reduce(lambda x, y: x & y,
                  [F.col(k).eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(keys)])


def flag_hot(df: DataFrame, keys: list[str], hot: HotKeys) -> DataFrame:
    """Add ``_is_hot``; the broadcast side is bounded by ``MAX_HOT_KEYS``."""
    marks = F.broadcast(hot.table.withColumn("_is_hot", F.lit(True)))
    joined = df.join(marks, same_keys(keys, "_hot_"), "left")
    return (joined.withColumn("_is_hot", F.coalesce("_is_hot", F.lit(False)))
            .drop(*[f"_hot_{i}" for i in range(len(keys))]))


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return epoch_micros(name).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    raise TypeError(f"order column {name} must be a timestamp or a number, not {kind}")


def _cuts(df: DataFrame, source: str, pieces: int) -> list[float]:
    shares = [i / pieces for i in range(1, pieces)]
    found = df.agg(F.percentile_approx(source, shares, max(10_000, 10 * pieces))).first()[0]
    return list(found or [])


def _bucket(df: DataFrame, source: str, target: str, cuts: list[float]) -> DataFrame:
    """Index of the cut interval, nulls first, in the order of ``source``."""
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    if len(splits) < 3:
        return df.withColumn(target, F.when(F.col(source).isNull(), 0).otherwise(1).cast("long"))
    out = Bucketizer(splits=splits, inputCol=source, outputCol=target,
                     handleInvalid="keep").transform(df)
    return out.withColumn(target, F.when(F.col(source).isNull(), 0)
                          .otherwise(F.col(target) + 1).cast("long"))


@dataclass(frozen=True)
class Chunked:
    """Rows with ``_chunk``, a bound on the number of (key, chunk) pairs, and how many tasks they fill."""

    rows: DataFrame
    bound: int
    tasks: int


def chunk_hot(df: DataFrame, keys: list[str], order: list[str],
              split_rows: int = SPLIT_ROWS) -> tuple[DataFrame, int] | None:
    """The rows of ``chunked`` and the bound, or None when no key is hot."""
    found = chunked(df, keys, order, split_rows)
    return None if found is None else (found.rows, found.bound)


def chunked(df: DataFrame, keys: list[str], order: list[str],
            split_rows: int = SPLIT_ROWS) -> Chunked | None:
    """Add ``_chunk``: -1 for ordinary keys, else an index that grows with ``order``.

    ``order`` is unique within a key; its first two columns are timestamps or numbers.
    The cut points are quantiles of the hot rows.  A single order value that is so
    frequent that no cut falls inside it is cut along the second column.
    None when no key is hot.
    """
    hot = hot_keys(df, keys, split_rows)
    if hot is None:
        return None
    pieces = min(10_000, 2 * max(2, math.ceil(hot.rows / split_rows)))
    marked = flag_hot(df, keys, hot).withColumn("_o", _number(df, order[0]))
    hot_rows = marked.where("_is_hot")
    cuts = _cuts(hot_rows, "_o", pieces)
    crowded = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    out = _bucket(marked, "_o", "_b", cuts)
    width = 1
    if crowded and len(order) > 1:
        marked = out.withColumn("_t", _number(df, order[1]))
        tie_cuts = _cuts(marked.where(F.col("_is_hot") & F.col("_o").isin(crowded)), "_t", pieces)
        out = _bucket(marked, "_t", "_s", tie_cuts)
        width = pieces + 3
        inner = F.when(F.col("_o").isin(crowded), F.col("_s")).otherwise(F.lit(width - 1))
        out = out.withColumn("_b", F.col("_b") * width + inner).drop("_t", "_s")
    out = (out.withColumn("_chunk", F.when(F.col("_is_hot"), F.col("_b")).otherwise(F.lit(-1)))
           .drop("_o", "_b", "_is_hot"))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(hot.all_rows / TASK_ROWS))
    return Chunked(out, hot.count * (pieces + 1) * width, tasks)


@dataclass(frozen=True)
class Running:
    """One output of ``running``: a count, an exact sum, a maximum or the previous value."""

    kind: str
    source: Column | None = None

    def local(self, w, rows) -> Column:
        if self.kind == "count":
            return F.row_number().over(w).cast("long")
        if self.kind == "previous":
            return F.lag(self.source).over(w)
        return (F.sum if self.kind == "sum" else F.max)(self.source).over(rows)

    def total(self, order: list[str]) -> Column:
        """What a whole chunk contributes to the chunks after it."""
        if self.kind == "count":
            return F.count(F.lit(1))
        if self.kind == "previous":
            return F.max_by(F.struct(self.source.alias("v")), F.struct(*order))
        return (F.sum if self.kind == "sum" else F.max)(self.source)

    def carried(self, total: str, across, before) -> Column:
        if self.kind == "previous":
            return F.lag(total).over(across)["v"]
        return (F.max if self.kind == "max" else F.sum)(total).over(before)

    def joined(self, here: Column, prior: Column, kind: T.DataType) -> Column:
        if self.kind == "previous":
            return F.when(F.col("_rn") == 1, prior).otherwise(here)
        if self.kind == "max":
            return F.greatest(here, prior)
        return F.when(here.isNull() | prior.isNull(), F.coalesce(here, prior)) \
                .otherwise(here + prior).cast(kind)


def running_count() -> Running:
    return Running("count")


def running_sum(source: Column) -> Running:
    return Running("sum", source)


def running_max(source: Column) -> Running:
    return Running("max", source)


def previous(source: Column) -> Running:
    return Running("previous", source)


def running(df: DataFrame, keys: list[str], order: list[str], outputs: dict[str, Running],
            split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Running values per key in ``order``, which must be unique within a key.

    The check for hot keys reads the key column once when this is called; put the
    result of an expensive plan into a table first (``session.durable``).
    """
    found = chunked(df, keys, order, split_rows)
    if found is None:
        return running_plain(df, keys, order, outputs)
    return running_chunked(found.rows, found.bound, keys, order, outputs, found.tasks).drop("_chunk")


def running_plain(df: DataFrame, keys: list[str], order: list[str],
                  outputs: dict[str, Running]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", *[r.local(w, rows).alias(n) for n, r in outputs.items()])


def running_chunked(df: DataFrame, bound: int, keys: list[str], order: list[str],
                    outputs: dict[str, Running], tasks: int | None = None) -> DataFrame:
    """``running`` over rows that ``chunked`` has marked, dealt to ``tasks`` tasks if that is given."""
    dealt, deal = df, []
    if tasks:
        # One number for key and chunk: a partitioning by keys that are doubles would not be taken as it is.
        deal = ["_deal"]
        dealt = df.withColumn("_deal", F.xxhash64(*keys, "_chunk")).repartition(tasks, "_deal")
    totals = [r.total(order).alias(f"_c_{n}") for n, r in outputs.items()]
    if tasks and any(r.kind == "previous" for r in outputs.values()):
        # The last row of a chunk is found by sorting: in tasks of bounded size, from the rows that are dealt anyway.
        # A filter on the chunk itself would go below the exchange, which would then serve this branch alone.
        cells = dealt.groupBy(*deal, *keys, "_chunk").agg(F.max("_chunk").alias("_c_at"), *totals).where("_c_at >= 0")
    else:
        cells = df.where(F.col("_chunk") >= 0).groupBy(*keys, "_chunk").agg(*totals)
    across = Window.partitionBy(*keys).orderBy("_chunk")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carry = cells.select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)],
                         F.col("_chunk").alias("_k_chunk"),
                         *[r.carried(f"_c_{n}", across, before).alias(f"_p_{n}")
                           for n, r in outputs.items()])
    if bound <= BROADCAST_ROWS:
        carry = F.broadcast(carry)

    w = Window.partitionBy(*deal, *keys, "_chunk").orderBy(*order)
    rows = w.rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.select("*", F.row_number().over(w).alias("_rn"),
                         *[r.local(w, rows).alias(f"_l_{n}") for n, r in outputs.items()])
    joined = local.join(carry, same_keys(keys, "_k_") & (F.col("_chunk") == F.col("_k_chunk")),
                        "left")
    return joined.select(*df.columns, *[
        r.joined(F.col(f"_l_{n}"), F.col(f"_p_{n}"), local.schema[f"_l_{n}"].dataType).alias(n)
        for n, r in outputs.items()])
