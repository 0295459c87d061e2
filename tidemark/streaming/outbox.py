"""Micro-batches that wait for every sink: each has a position, and one that fails goes on from its own.

A batch is written to the outbox once, in a folder that all executors share, and stays until every sink has
passed it. Sinks take batches in order under their numbers, so one that overwrites by number, as
``tables.put`` does, holds every row once however often it has failed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.streaming.sinks import BatchWriter


class Outbox:
    """Batches below ``path`` on their way to named sinks. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, sinks: Mapping[str, BatchWriter]):
        self.spark, self.path, self.schema, self.sinks = spark, path, schema, dict(sinks)
        self.failures: dict[str, str] = {}
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self, folder: str) -> list[int]:
        at = self._at(f"{self.path}/{folder}")
        if not self._files.exists(at):
            return []
        return sorted(int(n) for n in (s.getPath().getName() for s in self._files.listStatus(at)) if n.isdigit())

    def waiting(self) -> list[int]:
        """Numbers of the batches that some sink has not passed."""
        return [n for n in self._numbers("batch") if self._files.exists(self._at(f"{self.path}/batch/{n}/_SUCCESS"))]

    def position(self, sink: str) -> int:
        """Number of the last batch that the sink has taken, -1 before the first."""
        return max(self._numbers(f"position/{sink}"), default=-1)

    def _advance(self, sink: str, batch_id: int) -> None:
        """Make the new mark, then remove the old ones: a crash in between leaves the larger."""
        folder = f"{self.path}/position/{sink}"
        old = self._numbers(f"position/{sink}")
        self._files.mkdirs(self._at(f"{folder}/{batch_id}"))
        for number in old:
            if number < batch_id:
                self._files.delete(self._at(f"{folder}/{number}"), True)

    def put(self, batch: DataFrame, batch_id: int) -> None:
        """Keep a batch, offer every sink what it lacks, and let go what all have. Serves as a stream's step."""
        if batch_id > min((self.position(s) for s in self.sinks), default=-1):
            batch.select(*self.schema.fieldNames()).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true") \
                .parquet(f"{self.path}/batch/{batch_id}")
        self.flush()

    def flush(self) -> bool:
        """One attempt per sink at all it lacks; whether nothing is left."""
        numbers = self.waiting()
        self.failures = {}
        for name, write in self.sinks.items():
            behind = self.position(name)
            for number in (n for n in numbers if n > behind):
                try:
                    write(self.spark.read.schema(self.schema).parquet(f"{self.path}/batch/{number}"), number)
                except Exception as failure:  # noqa: BLE001 - any sink may fail in any way
                    self.failures[name] = f"{type(failure).__name__}: {failure}"
                    break
                self._advance(name, number)
        passed = min((self.position(s) for s in self.sinks), default=-1)
        for number in numbers:
            if number <= passed:
                self._files.delete(self._at(f"{self.path}/batch/{number}"), True)
        return not self.failures
