"""Batch-numbered tables: each micro-batch owns one folder and may be written again.

A replayed micro-batch overwrites its own folder, so a restart after a crash between
the sink and the commit log neither loses nor repeats rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"


def create(spark: SparkSession, path: str, schema: T.StructType,
           partition_by: tuple[str, ...] = ()) -> None:
    """Make the table readable before its first batch."""
    put(spark.createDataFrame([], schema), path, -1, partition_by, "ignore")


def put(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = (),
        mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{BATCH}={batch_id}")


def read(spark: SparkSession, path: str, schema: T.StructType,
         before: int | None = None) -> DataFrame:
    """Rows of all batches, or of those before one; the folder filter prunes the scan."""
    full = T.StructType(list(schema.fields)).add(BATCH, T.LongType())
    rows = spark.read.schema(full).parquet(path)
    return rows if before is None else rows.where(F.col(BATCH) < before)


def latest(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """Current value per key of a table of updates."""
    rest = [f.name for f in schema.fields if f.name != key]
    rows = read(spark, path, schema)
    newest = F.max_by(F.struct(*rest), F.col(BATCH)).alias("_r")
    return rows.groupBy(key).agg(newest).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])
