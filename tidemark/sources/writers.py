"""Sink encodings: keyed JSON and framed Avro records, and the log writer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import frame


# Written in full: the default keeps milliseconds only.
_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
          "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def encode_json(df: DataFrame, key: str) -> DataFrame:
    """``key`` and JSON ``value`` columns."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*df.columns), _TIMES).alias("value"))


def encode_avro(df: DataFrame, key: str, schema_id: int, schema: str) -> DataFrame:
    """``key`` and framed Avro ``value`` columns; needs Spark's Avro package."""
    from pyspark.sql.avro.functions import to_avro

    body = to_avro(F.struct(*df.columns), schema)
    return df.select(F.col(key).cast("string").alias("key"),
                     frame(body, schema_id).alias("value"))


def write_log(encoded: DataFrame, servers: str, topic: str,
              checkpoint: str | None = None) -> StreamingQuery | None:
    """Write ``key``/``value`` rows to a topic; a stream needs a checkpoint folder."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if not encoded.isStreaming:
        encoded.write.format("kafka").options(**options).save()
        return None
    return (encoded.writeStream.format("kafka").options(**options)
            .option("checkpointLocation", checkpoint).start())
