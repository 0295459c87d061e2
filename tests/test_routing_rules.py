"""One definition of a match, whatever the size of the binding table, on batches and streams."""

import pytest

from tidemark import schemas
from tidemark.operators import routing

BINDINGS = [("t", "TOPIC", "a.#", "all"), ("t", "TOPIC", None, "never"), ("t", "TOPIC", "a.b", "exact"), ("d", "DIRECT", None, "never"),
            ("d", "DIRECT", "k", None), ("d", "DIRECT", "k", "direct"), ("f", "FANOUT", None, "copy"), (None, "FANOUT", "x", "never")]
MESSAGES = [(1, "t", "a.b"), (2, "t", None), (3, "d", None), (4, "d", "k"), (5, "f", None), (6, None, "a.b"), (7, "d", "other")]
REACHED = [(1, "all"), (1, "exact"), (4, "direct"), (5, "copy")]
MANY = [("d", "DIRECT", f"unused{i}", "far") for i in range(201)]


def found(df):
    return sorted((r.id, r.queue) for r in df.collect())


@pytest.mark.parametrize("bindings,limits", [(BINDINGS, (200, 20_000)), (BINDINGS, (0, 20_000)), (BINDINGS, (0, 0)), (BINDINGS + MANY, (200, 20_000))])
def test_nulls_match_alike_in_every_plan(spark, bindings, limits):
    table = spark.createDataFrame(bindings, schemas.BINDING)
    messages = spark.createDataFrame(MESSAGES, "id int, exchange string, routing_key string")
    assert found(routing.route(messages, table, False, *limits)) == REACHED
    lost = routing.route(messages, table, True, *limits).where("queue IS NULL")
    assert sorted(r.id for r in lost.collect()) == [2, 3, 6, 7]


@pytest.mark.parametrize("limit", [200, 0])
def test_header_match_is_read_alike(spark, limit):
    table = spark.createDataFrame([("x", {"a": "1", "b": "2"}, "ANY", "any"), ("x", {"a": "1", "b": "2"}, None, "all"), ("x", {"a": "1"}, "any", None),
                                   ("x", None, "any", "never"), ("x", {"c": None}, "any", "never")], schemas.HEADER_BINDING)
    messages = spark.createDataFrame([(1, "x", {"a": "1"}), (2, "x", {"a": "1", "b": "2", "c": None}), (3, "x", None), (4, "y", {"a": "1"})],
                                     "id int, exchange string, headers map<string,string>")
    assert found(routing.route_by_headers(messages, table, limit)) == [(1, "any"), (2, "all"), (2, "any")]


def test_streams_take_any_number_of_bindings(spark, tmp_path):
    spark.createDataFrame(MESSAGES, "id int, exchange string, routing_key string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, exchange string, routing_key string").parquet(str(tmp_path / "in"))
    routed = routing.route(stream, spark.createDataFrame(BINDINGS + MANY, schemas.BINDING))
    query = (routed.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "mark")).option("path", str(tmp_path / "out"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert found(spark.read.parquet(str(tmp_path / "out"))) == REACHED
