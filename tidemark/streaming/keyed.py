"""Duplicates and retries in state that event-time timers free, or in Spark's own for ids kept for ever.

Ids that are kept for ever are Spark's: a batch looks up its own ids. The rest is Python's, where a call
costs more than a row: ids are dealt to ``GROUPS`` groups by hash, and a group is one key of the state store.
A batch reads and writes the live ids of the groups that it touches, or, where rows only wait, what it parks
and what is due. A group's rows of one micro-batch are sorted in memory; a source's limit per trigger bounds them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.columns import dedup_id, epoch_micros
from tidemark.functions.packed import as_text, pack, unpack
from tidemark.operators.dedup import DAY_SECONDS, FIFO_SECONDS
from tidemark.operators.retry import AS_CODED

#: Keys of the state store, whatever the number of ids. A query keeps the number it was started with.
GROUPS = 4096
#: So many waiting rows share an entry of the state, and so a timer.
PARKED_ROWS = 1024
#: Rows of a group that are collected before the first ones are picked.
PENDING_ROWS = 1 << 16

_ROW = "row string"


def _stored(texts: list[str], numbers: list[int]) -> tuple[bytes]:
    batch = pa.record_batch({"text": pa.array(texts, pa.string()), "number": pa.array(numbers, pa.int64())})
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return (out.getvalue().to_pybytes(),)


def _loaded(value: tuple) -> tuple[list[str], list[int]]:
    table = pa.ipc.open_stream(bytes(value[0])).read_all()
    return table["text"].to_pylist(), table["number"].to_pylist()


def _rows(rows: list[str]) -> Iterator[pd.DataFrame]:
    if rows:
        yield pd.DataFrame({"row": rows})


class _Accept:
    """Lets a row through if no row of its id was let through less than ``span`` before."""

    def __init__(self, span: int):
        self.span = span

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, tie, ids, rows = [], [], [], []
        for frame in frames:
            for column, name in ((at, "at"), (tie, "tie"), (ids, "id"), (rows, "row")):
                column.extend(frame[name].tolist())
        last, kept = dict(zip(*_loaded(state.get))) if state.exists else {}, []
        for n in sorted(range(len(at)), key=lambda n: (at[n], tie[n])):
            seen = last.get(ids[n])
            if seen is None or at[n] >= seen + self.span:
                last[ids[n]] = at[n]
                kept.append(rows[n])
        self._keep(last, state)
        yield from _rows(kept)

    def _keep(self, last: dict[str, int], state: GroupState) -> None:
        """Ids whose rows could still be duplicates; those of any other would be late by now.

        A group that gets no more rows goes with its last id.
        """
        now = state.getCurrentWatermarkMs() * 1000
        live = {i: at for i, at in last.items() if at + self.span >= now}
        if live:
            state.update(_stored(list(live), list(live.values())))
            state.setTimeoutTimestamp((max(live.values()) + self.span) // 1000 + 1)
        elif state.exists:
            state.remove()


def _ordered(stream: DataFrame, order: list[str], key: str) -> DataFrame:
    """Rows with a time, and their time, tie, id and group."""
    return stream.where(F.col(order[0]).isNotNull()).select(
        "*", _group(key).alias("_group"), epoch_micros(order[0]).alias("_at"),
        F.coalesce(F.col(order[1]).cast("double"), F.lit(float("-inf"))).alias("_tie"),
        F.coalesce(F.concat(F.lit("="), as_text(F.col(key), stream.select(key).schema[0].dataType)), F.lit("")).alias("_id"))


def _group(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(GROUPS)).cast("int")


def _event_time(ts: str) -> Column:
    """The time that late rows are told by, within the range of pandas."""
    return F.greatest(F.least(F.col(ts), F.lit("2262-01-01").cast("timestamp")), F.lit("1678-01-01").cast("timestamp"))


def keep_within_ttl(stream: DataFrame, order: list[str], ttl: float = DAY_SECONDS, key: str = "message_id",
                    lateness: str = "3 days") -> DataFrame:
    """Accept an id again once ``ttl`` has passed since it was last accepted, exactly.

    ``order`` is the timestamp and a number that breaks ties. A row exactly at expiry is accepted, one
    behind an accepted row of its id is a duplicate, one without a time stamp is never accepted, and
    rows without an id share one. Rows more than ``lateness`` behind the newest are dropped, and an id's
    state goes when they could no longer be its duplicates.
    """
    rows = _ordered(stream, order, key).withColumn("_time", _event_time(order[0])).withWatermark("_time", lateness)
    rows = rows.select(F.col("_group").alias("group"), F.col("_time").alias("time"), F.col("_at").alias("at"),
                       F.col("_tie").alias("tie"), F.col("_id").alias("id"), pack(stream.schema).alias("row"))
    kept = rows.groupBy("group").applyInPandasWithState(_Accept(round(ttl * 1_000_000)), _ROW, "ids binary", "append",
                                                        GroupStateTimeout.EventTimeTimeout)
    return unpack(kept, "row", stream.schema)


def keep_fifo(stream: DataFrame, order: list[str], body: str = "body", explicit_id: str | None = None,
              window: float = FIFO_SECONDS, lateness: str = "1 day") -> DataFrame:
    """Messages let through by a five-minute queue: explicit id first, else content hash."""
    keyed = stream.withColumn("dedup_id", dedup_id(explicit_id, body))
    return keep_within_ttl(keyed, order, window, "dedup_id", lateness)


def _earliest(rows: pa.Table) -> pa.Table:
    """The first row, by time and tie, of every id."""
    ids = rows["_id"].combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.lexsort((rows["_tie"].to_numpy(), rows["_at"].to_numpy(), ids))
    ids = ids[order]
    return rows.take(order[np.concatenate(([True], ids[1:] != ids[:-1]))])


def keep_once(stream: DataFrame, order: list[str], key: str = "message_id") -> DataFrame:
    """Accept every id once and for ever: the first row, by ``order``, of the batch that brings the id."""
    rows = _ordered(stream, order, key)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size, limit = [], 0, PENDING_ROWS
        for batch in batches:
            pending.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size > limit:
                pending = [_earliest(pa.concat_tables(pending))]
                size, limit = pending[0].num_rows, 2 * pending[0].num_rows + PENDING_ROWS
        if size:
            yield from _earliest(pa.concat_tables(pending)).combine_chunks().to_batches()

    return rows.groupBy("_group").applyInArrow(first, rows.schema).dropDuplicates(["_id"]).select(*stream.columns)


class _Wait(StatefulProcessor):
    """Holds rows back until the watermark has reached their time."""

    def init(self, handle) -> None:
        self.handle, self.parked = handle, handle.getMapState("parked", "wake long", "rows binary")

    def handleInputRows(self, key, frames, timerValues) -> Iterator[pd.DataFrame]:
        now, waiting = timerValues.getCurrentWatermarkInMs() * 1000, []
        for frame in frames:
            ready = frame["due"] <= now
            yield from _rows(frame["row"][ready].tolist())
            waiting.extend(zip(frame["due"][~ready].tolist(), frame["row"][~ready].tolist()))
        self._park(waiting)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, wake = timerValues.getCurrentWatermarkInMs() * 1000, (expiredTimerInfo.getExpiryTimeInMs(),)
        rows, dues = _loaded(self.parked.getValue(wake))
        self.parked.removeKey(wake)
        yield from _rows([row for row, due in zip(rows, dues) if due <= now])
        self._park([(due, row) for row, due in zip(rows, dues) if due > now])

    def _park(self, waiting: list[tuple[int, str]]) -> None:
        """Rows in runs of neighbouring times; a run wakes at its first time, and what is not due then is parked anew."""
        waiting.sort()
        for n in range(0, len(waiting), PARKED_ROWS):
            dues, rows = map(list, zip(*waiting[n:n + PARKED_ROWS]))
            wake = -(-dues[0] // 1000)
            if self.parked.containsKey((wake,)):
                more_rows, more_dues = _loaded(self.parked.getValue((wake,)))
                rows, dues = rows + more_rows, dues + more_dues
            self.parked.updateValue((wake,), _stored(rows, dues))
            self.handle.registerTimer(wake)

    def close(self) -> None:
        pass


def retry_ladder(stream: DataFrame, failing: Column, key: str = "message_id", delays: Sequence[int] = AS_CODED,
                 ts: str = "created_at", lateness: str = "1 hour") -> DataFrame:
    """Messages with ``attempt``, ``state`` (``OK`` or ``DEAD``) and ``finished_at``, when they are done.

    The clock is event time: a message that fails waits in keyed state until the watermark passes its last
    attempt, and blocks no other. ``failing`` is evaluated for every attempt and may use the column
    ``attempt`` (from 1); after ``len(delays)`` failed retries a message is dead. Delays must be positive.
    """
    if not delays or min(delays) <= 0:
        raise ValueError("delays must be positive")
    rows, schema = stream.where(F.col(ts).isNotNull()).withColumn("_time", _event_time(ts)).withWatermark("_time", lateness), stream.schema
    for attempt in range(1, len(delays) + 2):
        rows = rows.withColumn("attempt", F.lit(attempt)).withColumn(f"_f{attempt}", F.coalesce(failing, F.lit(False)))
    ends = F.coalesce(*[F.when(~F.col(f"_f{a}"), F.lit(a)) for a in range(1, len(delays) + 2)])
    waits = F.array(*[F.lit(sum(delays[:n]) * 1_000_000).cast("long") for n in range(len(delays) + 1)])
    attempt = F.coalesce(ends, F.lit(len(delays) + 1))
    rows = rows.select(*schema.fieldNames(), "_time", epoch_micros(ts).alias("_at"), attempt.alias("attempt"),
                       F.when(ends.isNull(), "DEAD").otherwise("OK").alias("state"))
    rows = rows.withColumn("_done", F.col("_at") + F.element_at(waits, F.col("attempt"))).withColumn("finished_at", F.timestamp_micros("_done"))
    out = T.StructType([*schema.fields, T.StructField("attempt", T.IntegerType()), T.StructField("state", T.StringType()),
                        T.StructField("finished_at", T.TimestampType())])
    at_once = (F.col("attempt") == 1) & (F.col("state") == "OK")
    rows = rows.select(_group(key, "_at").alias("group"), F.col("_time").alias("time"),
                       F.when(at_once, F.lit(-(2 ** 63))).otherwise(F.col("_done")).alias("due"), pack(out).alias("row"))
    done = rows.groupBy("group").transformWithStateInPandas(_Wait(), _ROW, "append", "EventTime")
    return unpack(done, "row", out)
