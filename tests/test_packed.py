"""Rows that travel as text come back as they were."""

import math
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import types as T

from tidemark.functions.packed import pack, unpack

SCHEMA = """s string, b binary, t timestamp, n timestamp_ntz, d date, x double, f float, i long, k tinyint, o boolean, m decimal(38,10),
    a array<struct<x:double,t:timestamp>>, p map<int,array<string>>, q struct<l:long,r:struct<z:string>>"""


def test_every_type_and_null(spark):
    schema, far = T._parse_datatype_string(SCHEMA), datetime(3000, 1, 1, 0, 0, 0, 1)
    rows = [("a\"\\\n é{}", bytes([0, 255]), datetime(1500, 2, 3, 4, 5, 6, 789_012), far, date(9999, 12, 31), -0.0, 0.1, 2 ** 63 - 1, -128, False,
             Decimal("1234567890123456789012345678.0123456789"), [(5e-324, far), None, (None, None)], {1: ["", None], 2: None, 3: []}, (2 ** 53 + 1, None)),
            ("", b"", None, None, None, float("nan"), float("-inf"), None, None, True, Decimal(0), [], {}, (None, (None,))),
            ("null", None, None, None, None, 1.7976931348623157e308, None, -(2 ** 63), 1, None, None, None, None, (1, ("",))),
            tuple([None] * 14)]
    df = spark.createDataFrame(rows, schema)
    back = unpack(df.select(pack(schema).alias("row")), "row", schema)
    assert back.dtypes == df.dtypes

    def shown(frame):
        return sorted(repr(r) for r in frame.collect())

    assert shown(back) == shown(df)
    zero = next(r["x"] for r in back.collect() if r["k"] == -128)
    assert math.copysign(1, zero) == -1
