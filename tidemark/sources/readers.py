"""Sources: keyed JSON and framed Avro logs, and files.

The Kafka and Avro data sources are separate Spark packages.  Without them the
functions that name them fail when called; the decoding functions work on any
DataFrame with the columns of a log.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import frame_body, frame_schema_id

LOG_METADATA = ("key", "topic", "partition", "offset", "timestamp")


def start_options(position: str | datetime | dict = "earliest") -> dict[str, str]:
    """Where a reader without a checkpoint begins.

    ``earliest`` or ``latest``, a point in time, or offsets as
    ``{topic: {partition: offset}}``.  Replaying means a new checkpoint with one of these.
    """
    if isinstance(position, datetime):
        return {"startingTimestamp": str(int(position.timestamp() * 1000))}
    if isinstance(position, dict):
        return {"startingOffsets": json.dumps(
            {t: {str(p): o for p, o in parts.items()} for t, parts in position.items()})}
    if position not in ("earliest", "latest"):
        raise ValueError(f"unknown position {position!r}")
    return {"startingOffsets": position}


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 position: str | datetime | dict = "earliest",
                 max_per_trigger: int | None = None) -> DataFrame:
    """Raw log rows as a stream; ``max_per_trigger`` bounds a poll."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).options(**start_options(position)))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def kafka_batch(spark: SparkSession, servers: str, topic: str,
                position: str | datetime | dict = "earliest") -> DataFrame:
    """Everything in the log from ``position`` to its current end."""
    return (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).options(**start_options(position))
            .option("endingOffsets", "latest").load())


def decode_json_log(log: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of JSON values beside the key, partition, offset and time of each record."""
    meta = [F.col(c) if c != "key" else F.col(c).cast("string").alias("key")
            for c in LOG_METADATA if c in log.columns]
    return log.select(*meta, F.from_json(F.col("value").cast("string"), schema).alias("_r")) \
        .select(*[c for c in LOG_METADATA if c in log.columns], "_r.*")


def decode_framed(log: DataFrame) -> DataFrame:
    """Split framed values into ``schema_id`` (null if the frame is broken) and ``body``."""
    return log.withColumns({"schema_id": frame_schema_id("value"), "body": frame_body("value")}) \
        .drop("value")


def decode_avro_log(log: DataFrame, schemas: dict[int, str], reader_schema: str) -> DataFrame:
    """Fields of framed Avro values, each decoded with the schema its frame names."""
    from pyspark.sql.avro.functions import from_avro

    framed = decode_framed(log)
    record = F.coalesce(*[
        F.when(F.col("schema_id") == sid,
               from_avro("body", writer, {"avroSchema": reader_schema, "mode": "PERMISSIVE"}))
        for sid, writer in sorted(schemas.items())])
    keep = [c for c in framed.columns if c not in ("body",)]
    return framed.select(*keep, record.alias("_r")).select(*keep, "_r.*")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None, zoned: bool = True,
                with_metadata: bool = False) -> DataFrame:
    """Files of a folder as a stream, oldest first; ``max_files`` bounds a poll.

    Watermarks need timestamps with a zone, so zone-less columns are read as UTC
    unless ``zoned`` is off.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(path)
    if with_metadata:
        rows = rows.select("*", F.col("_metadata.file_path").alias("source_file"),
                           F.col("_metadata.file_modification_time").alias("source_time"))
    if zoned:
        local = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
        rows = rows.withColumns({c: F.col(c).cast("timestamp") for c in local})
    return rows
