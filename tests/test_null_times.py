"""Deliveries without a time stamp or an id, in batch and over micro-batches."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

from tidemark.operators.dedup import accepted_within_ttl
from tidemark.streaming import dedup, tables

SCHEMA = T.StructType().add("message_id", "string").add("created_at", T.TimestampNTZType()).add("offset", "long")
T0 = datetime(2024, 3, 1)
ROWS = [("a", None, 0), ("a", None, 1), ("a", T0, 2), (None, T0, 3), (None, T0 + timedelta(seconds=5), 4), (None, None, 5)]


def test_batch_and_stream_share_the_rule(spark, tmp_path):
    batch = accepted_within_ttl(spark.createDataFrame(ROWS, SCHEMA), ["created_at", "offset"], 100)
    assert sorted(r.offset for r in batch.collect()) == [2, 3]
    path = str(tmp_path / "ttl")
    step = dedup.accept_within_ttl(path, SCHEMA, ["created_at", "offset"], 100)
    for n, row in enumerate(ROWS):
        step(spark.createDataFrame([row], SCHEMA), n)
    assert sorted(r.offset for r in tables.read(spark, path, SCHEMA).collect()) == [2, 3]


def test_rows_without_id_are_accepted_once(spark, tmp_path):
    path = str(tmp_path / "once")
    step = dedup.accept_once(path, SCHEMA, ["offset"])
    for n in range(3):
        step(spark.createDataFrame([(None, T0, n), ("a", T0, n)], SCHEMA), n)
    got = sorted((r.message_id or "", r.offset) for r in tables.read(spark, path, SCHEMA).collect())
    assert got == [("", 0), ("a", 0)]
