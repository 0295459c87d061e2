"""Encodings of log records, and the options of the log reader."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import readers, writers


def test_json_round_trip_keeps_key_and_position(spark):
    df = spark.createDataFrame([("o1", "c1", 5.0, "PLACED", datetime(2024, 1, 1, 0, 0, 1, 5))],
                               schemas.BASIC_ORDER)
    log = writers.encode_json(df, "order_id").withColumns({
        "key": F.col("key").cast("binary"), "value": F.col("value").cast("binary"),
        "partition": F.lit(2), "offset": F.lit(41).cast("long")})
    back = readers.decode_json_log(log, schemas.BASIC_ORDER)
    assert back.columns == ["key", "partition", "offset", *df.columns]
    row = back.first()
    assert (row.key, row.partition, row.offset) == ("o1", 2, 41)
    assert tuple(row)[3:] == tuple(df.first())


def test_unknown_and_missing_json_fields(spark):
    log = spark.createDataFrame([('{"order_id": "o", "extra": 1}',), ("{oops",)], "value string")
    rows = readers.decode_json_log(log, schemas.BASIC_ORDER).collect()
    assert rows[0].order_id == "o" and rows[0].amount is None
    assert rows[1].order_id is None


def test_framed_values(spark):
    log = spark.createDataFrame([("k", bytearray(b"\x00\x00\x00\x01\x00xy"))],
                                "key string, value binary")
    row = readers.decode_framed(log).first()
    assert (row.key, row.schema_id, bytes(row.body)) == ("k", 256, b"xy")


def test_start_positions():
    assert readers.start_options() == {"startingOffsets": "earliest"}
    assert readers.start_options("latest") == {"startingOffsets": "latest"}
    when = datetime(2024, 1, 1, tzinfo=timezone.utc)
    assert readers.start_options(when) == {"startingTimestamp": "1704067200000"}
    assert json.loads(readers.start_options({"t": {0: 5}})["startingOffsets"]) == {"t": {"0": 5}}
    with pytest.raises(ValueError):
        readers.start_options("middle")


def test_avro_schema_text():
    v2 = json.loads(schemas.avro_schema("OrderEventV2", schemas.ORDER_V2))
    fields = {f["name"]: f for f in v2["fields"]}
    assert fields["status"]["type"]["symbols"] == list(schemas.ORDER_STATUSES)
    assert fields["amount"]["type"] == "double"
    assert fields["region"]["default"] == "UNKNOWN"
    assert fields["customer_email"]["type"] == ["null", "string"]
    assert fields["customer_email"]["default"] is None
