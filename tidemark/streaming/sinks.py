"""Starting queries, and sinks that write several or updated outputs."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.session import DEFAULTS
from tidemark.streaming import tables

BatchWriter = Callable[[DataFrame, int], None]

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_starting = threading.Lock()


@contextmanager
def _keyed_store(spark: SparkSession) -> Iterator[None]:
    """A query keeps the settings it was started with, so the session gets its own back."""
    with _starting:
        before = spark.conf.get(_PROVIDER, None)
        spark.conf.set(_PROVIDER, DEFAULTS[_PROVIDER])
        try:
            yield
        finally:
            if before is None:
                spark.conf.unset(_PROVIDER)
            else:
                spark.conf.set(_PROVIDER, before)


def start(stream: DataFrame, step: BatchWriter, checkpoint: str, mode: str = "append",
          every: str | None = "1 second", keyed_state: bool = False) -> StreamingQuery:
    """Run ``step`` per micro-batch; ``every=None`` drains what is there and stops.

    ``keyed_state`` is for streams of ``streaming.keyed``: Spark's default state store cannot hold their
    states, so they get the one that ``build_session`` names, whatever the session has.
    """
    writer = stream.writeStream.outputMode(mode).foreachBatch(step) \
        .option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = writer.trigger(**trigger)
    if not keyed_state:
        return writer.start()
    with _keyed_store(stream.sparkSession):
        return writer.start()


def start_readers(source: Callable[[], DataFrame], steps: Mapping[str, BatchWriter],
                  checkpoint_root: str, every: str | None = "1 second") -> dict[str, StreamingQuery]:
    """Independent readers: every one has its own position and sees every record."""
    return {name: start(source(), step, f"{checkpoint_root}/{name}", every=every)
            for name, step in steps.items()}


def changelog(path: str) -> BatchWriter:
    """Keep the changed rows of an ``update``-mode aggregation; see ``tables.latest``."""
    return lambda batch, batch_id: tables.put(batch, path, batch_id)


def append(path: str) -> BatchWriter:
    """Append-only table, replay-safe."""
    return lambda batch, batch_id: tables.put(batch, path, batch_id)


OUTCOME = "sink string, ok boolean, error string"


def fan_out(sinks: Mapping[str, BatchWriter], outcomes: str) -> BatchWriter:
    """Write each micro-batch to several sinks from one computation of it.

    A failing sink is recorded in the ``outcomes`` table and does not stop the others.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        results = []
        try:
            for name, write in sinks.items():
                try:
                    write(batch, batch_id)
                    results.append((name, True, None))
                except Exception as failure:  # noqa: BLE001 - any sink may fail in any way
                    results.append((name, False, f"{type(failure).__name__}: {failure}"))
            tables.put(batch.sparkSession.createDataFrame(results, OUTCOME), outcomes, batch_id)
        finally:
            batch.unpersist()

    return step


def stored_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Keys and values held by a stateful query, read from its checkpoint."""
    return spark.read.format("statestore").load(checkpoint)


def late_rows(query: StreamingQuery) -> int:
    """Rows a query has dropped for arriving behind its watermark."""
    return sum(op.numRowsDroppedByWatermark
               for progress in query.recentProgress for op in _operators(progress))


def _operators(progress):
    return getattr(progress, "stateOperators", None) or []


class ObservedMetrics(StreamingQueryListener):
    """Collects the metrics of ``filters.tap`` as (query id, tap name, row) triples."""

    def __init__(self) -> None:
        self.seen: list[tuple[str, str, dict]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            self.seen.append((str(event.progress.id), name, row.asDict()))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def with_heartbeat(stream: DataFrame, spark: SparkSession) -> DataFrame:
    """Keep micro-batches coming while the topic is idle, so that due retries run."""
    beats = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    none = beats.where(F.col("value") < 0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields])
    return stream.unionByName(none)
