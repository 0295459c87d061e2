"""The contract audit reads its records once, and has findings without any."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import contract

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("amount", T.DoubleType()), T.StructField("status", T.StringType())])
RECORDS = ['{"id":"1","amount":2.5,"status":"PLACED"}', '{"id":"2","status":"LOST","extra":1,"extra":2}', '{"id":null,"more":{"extra":1}}', "{broken", None, "{}"]


def findings(df):
    return {(r.field, r.issue): (r.records, r.bad_records, r.share) for r in contract.audit(df, "value", SCHEMA).collect()}


def test_counts_and_one_scan(spark, tmp_path):
    spark.createDataFrame([(r, 1) for r in RECORDS], "value string, field int").write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    assert findings(raw) == {("id", "null"): (6, 4, 4 / 6), ("amount", "null"): (6, 5, 5 / 6), ("status", "null"): (6, 4, 4 / 6),
                             ("status", "bad_symbol"): (6, 1, 1 / 6), ("extra", "unexpected"): (1, 1, None), ("more", "unexpected"): (1, 1, None)}
    plan = contract.audit(raw, "value", SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_no_records(spark):
    none = spark.createDataFrame([], "value string")
    assert findings(none) == {(f, i): (0, 0, None) for f, i in (("id", "null"), ("amount", "null"), ("status", "null"), ("status", "bad_symbol"))}
    assert not contract.audit(none, "value", SCHEMA).where(F.col("issue") == "unexpected").count()
