"""A table of the newest row per key, fed by micro-batches: deltas in hash buckets, folded into bases.

What is current is named by one manifest: a base, the batches since, and the last batch that the base
holds. A put writes its delta and then the next manifest; every ``fold`` batches the base is written anew.
Readers see the manifest they began with: folders stay for one more base. So a read costs a
base and at most ``fold`` deltas however many batches there were, and a lookup one bucket of each.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET, _BATCH = "_bucket", "_batch"


class UpsertTable:
    """Newest row per key below ``path``, a folder that all executors share. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str],
                 buckets: int = 16, fold: int = 8):
        self.spark, self.path, self.schema, self.key = spark, path, schema, list(key)
        self.buckets, self.fold = buckets, fold
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        folder = self._at(f"{self.path}/manifest")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def manifest(self) -> dict:
        numbers = self._numbers()
        if not numbers:
            return {"base": None, "folded": -1, "deltas": [], "old": []}
        stream = self._files.open(self._at(f"{self.path}/manifest/{numbers[-1]}"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        """Readers change over with the rename; all but the last two manifests go."""
        numbers = self._numbers()
        number = numbers[-1] + 1 if numbers else 0
        draft = self._at(f"{self.path}/manifest/{number}.draft")
        out = self._files.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not self._files.rename(draft, self._at(f"{self.path}/manifest/{number}")):
            raise RuntimeError(f"another writer has published manifest {number} of {self.path}")
        for old in numbers[:-1]:
            self._files.delete(self._at(f"{self.path}/manifest/{old}"), False)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))

    def put(self, df: DataFrame, batch_id: int) -> None:
        """Insert or replace the rows; at most one per key. A batch that is known is not put again."""
        now = self.manifest()
        if batch_id <= now["folded"] or batch_id in now["deltas"]:
            return
        delta = f"delta/{batch_id}"
        self._bucketed(df.select(*self.schema.fieldNames())).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/{delta}")
        now["deltas"].append(batch_id)
        gone = []
        if len(now["deltas"]) >= self.fold:
            base = f"base/{batch_id}"
            self._bucketed(self._newest(now)).repartition(self.buckets, _BUCKET) \
                .write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/{base}")
            gone = now["old"]
            replaced = [f"delta/{b}" for b in now["deltas"]] + ([now["base"]] if now["base"] else [])
            now = {"base": base, "folded": batch_id, "deltas": [], "old": replaced}
        self._publish(now)
        for folder in gone:
            self._files.delete(self._at(f"{self.path}/{folder}"), True)

    def _newest(self, manifest: dict, only: Sequence[int] | None = None) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField(_BUCKET, T.IntegerType())])
        parts = [(manifest["base"], -1)] if manifest["base"] else []
        parts += [(f"delta/{b}", b) for b in manifest["deltas"]]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        tables = [self.spark.read.schema(full).parquet(f"{self.path}/{folder}").withColumn(_BATCH, F.lit(b).cast("long"))
                  for folder, b in parts]
        rows = reduce(DataFrame.unionByName, tables)
        if only is not None:
            rows = rows.where(F.col(_BUCKET).isin(list(only)))
        newest = Window.partitionBy(*self.key).orderBy(F.desc(_BATCH))
        return rows.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").select(*self.schema.fieldNames())

    def read(self) -> DataFrame:
        """The newest row of every key."""
        return self._newest(self.manifest())

    def lookup(self, keys: Sequence[tuple]) -> DataFrame:
        """The newest rows of some keys; reads their buckets only."""
        asked = self.spark.createDataFrame(list(keys), T.StructType([self.schema[k] for k in self.key]))
        buckets = [r[0] for r in self._bucketed(asked).select(_BUCKET).distinct().collect()]
        return self._newest(self.manifest(), buckets).join(F.broadcast(asked), self.key, "left_semi")


def upsert(table: UpsertTable):
    """Sink of an ``update``-mode aggregation."""
    return lambda batch, batch_id: table.put(batch, batch_id)
