"""Streams: agreement with batch, emission rules, restarts and multi-table flows."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import aggregates, filters, joins, metrics, routing
from tidemark.operators.retry import replay
from tidemark.sources.readers import file_stream
from tidemark.streaming import dedup, retry, sinks, tables

T0 = datetime(2024, 3, 1, 12, 0, 0)
EVENTS = "/root/testdata/sf0.001/events.parquet"


def at(s):
    return T0 + timedelta(seconds=s)


class Feed:
    """A folder that receives one file per ``push``, and streams over it."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema
        self.n = 0
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.path}/f=0")

    def push(self, rows):
        self.n += 1
        self.spark.createDataFrame(rows, self.schema).coalesce(1) \
            .write.parquet(f"{self.path}/f={self.n}")

    def stream(self, **options):
        return file_stream(self.spark, f"{self.path}/*", self.schema, **options)


def drain(stream, step, checkpoint, mode="append"):
    query = sinks.start(stream, step, str(checkpoint), mode, every=None)
    query.awaitTermination()
    return query


def zoned(schema):
    return T.StructType([T.StructField(f.name, T.TimestampType() if isinstance(
        f.dataType, T.TimestampNTZType) else f.dataType) for f in schema.fields])


ORDER = T.StructType([f for f in schemas.ORDER_EVENT.fields])


def order(i, t, customer="c", amount=1.0, status="PLACED"):
    return (f"m{i}", f"o{i}", customer, amount, "Pen", status, at(t))


@pytest.fixture
def orders(spark, tmp_path):
    return Feed(spark, tmp_path / "orders", ORDER)


def as_naive(value):
    return value.astimezone(timezone.utc).replace(tzinfo=None) if value and value.tzinfo else value


def test_keyed_count_of_a_stream_equals_batch(spark, tmp_path):
    from tidemark.plans import views
    batch = spark.read.parquet(EVENTS)
    stream = views.as_orders(file_stream(spark, EVENTS.replace("events", "event[s]"), batch.schema))
    counted = aggregates.orders_per_customer(stream)
    drain(counted, sinks.changelog(str(tmp_path / "out")), tmp_path / "ck", "update")
    got = tables.latest(spark, str(tmp_path / "out"), counted.schema, "customer_id")
    want = aggregates.orders_per_customer(views.as_orders(batch))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    state = sinks.stored_state(spark, str(tmp_path / "ck"))
    assert state.count() == want.count()


def test_updates_and_final_rows_of_windows(spark, orders, tmp_path):
    windows = aggregates.revenue_windows(orders.stream(max_files=1))
    orders.push([order(1, 0, amount=5.0), order(2, 10, amount=7.0)])
    drain(windows, sinks.changelog(str(tmp_path / "u")), tmp_path / "cu", "update")
    orders.push([order(3, 20, amount=1.0), order(4, 70, amount=2.0)])
    drain(windows, sinks.changelog(str(tmp_path / "u")), tmp_path / "cu", "update")
    changes = tables.read(spark, str(tmp_path / "u"), windows.schema).collect()
    assert sorted((r.total_revenue, r.order_count) for r in changes) == [
        (2.0, 1), (12.0, 2), (13.0, 3)]
    drain(windows, sinks.append(str(tmp_path / "f")), tmp_path / "cf", "append")
    final = tables.read(spark, str(tmp_path / "f"), windows.schema).collect()
    assert [(r.total_revenue, r.order_count) for r in final] == [(13.0, 3)]


def test_late_rows_are_dropped_and_counted(spark, orders, tmp_path):
    windows = aggregates.revenue_windows(orders.stream(max_files=1))
    orders.push([order(1, 0), order(2, 200)])
    drain(windows, sinks.append(str(tmp_path / "o")), tmp_path / "c", "append")
    orders.push([order(3, 10), order(4, 400)])
    query = drain(windows, sinks.append(str(tmp_path / "o")), tmp_path / "c", "append")
    rows = tables.read(spark, str(tmp_path / "o"), windows.schema).collect()
    assert sorted(r.order_count for r in rows) == [1, 1]
    assert sinks.late_rows(query) >= 1


def test_grace_keeps_late_rows(spark, orders, tmp_path):
    windows = aggregates.revenue_windows(orders.stream(max_files=1), grace="10 minutes")
    for rows in ([order(1, 0), order(2, 200)], [order(3, 10)], [order(4, 2000)]):
        orders.push(rows)
        drain(windows, sinks.append(str(tmp_path / "o")), tmp_path / "c", "append")
    rows = tables.read(spark, str(tmp_path / "o"), windows.schema).collect()
    assert sorted(r.order_count for r in rows) == [1, 2]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_stream_join(spark, orders, tmp_path, how):
    pays = Feed(spark, tmp_path / "pay", schemas.PAYMENT_EVENT)
    orders.push([order(1, 0), order(2, 0), order(3, 0)])
    pays.push([("o1", "p1", "UPI", "SUCCESS", 1.0, at(30)), ("o2", "p2", "UPI", "SUCCESS", 1.0, at(31))])
    joined = joins.enrich_orders(orders.stream(), pays.stream(), how)
    step = sinks.append(str(tmp_path / "out"))
    drain(joined, step, tmp_path / "ck")
    orders.push([order(9, 1000)])
    pays.push([("o9", "p9", "UPI", "SUCCESS", 1.0, at(1000))])
    drain(joined, step, tmp_path / "ck")
    orders.push([order(10, 2000)])
    pays.push([("x", "px", "UPI", "SUCCESS", 1.0, at(2000))])
    drain(joined, step, tmp_path / "ck")
    got = {(r.order_id, r.payment_status, r.join_type)
           for r in tables.read(spark, str(tmp_path / "out"), joined.schema).collect()}
    want = {("o1", "SUCCESS", "INNER_JOIN"), ("o9", "SUCCESS", "INNER_JOIN")}
    if how == "left":
        want |= {("o2", "PENDING", "LEFT_JOIN"), ("o3", "PENDING", "LEFT_JOIN")}
    assert got == want


def test_restart_continues_where_it_stopped(spark, orders, tmp_path):
    counted = aggregates.orders_per_customer(orders.stream())
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    orders.push([order(1, 0, "a"), order(2, 1, "b")])
    query = sinks.start(counted, sinks.changelog(out), ck, "update", every="1 second")
    query.processAllAvailable()
    query.stop()
    orders.push([order(3, 2, "a"), order(4, 3, None)])
    query = sinks.start(counted, sinks.changelog(out), ck, "update", every="1 second")
    query.processAllAvailable()
    query.stop()
    got = tables.latest(spark, out, counted.schema, "customer_id").collect()
    assert sorted(map(tuple, got)) == [("a", 2), ("b", 1)]


def test_independent_readers_both_see_everything(spark, orders, tmp_path):
    orders.push([order(1, 0), order(2, 0)])
    started = sinks.start_readers(orders.stream, {
        "inventory": sinks.append(str(tmp_path / "inventory")),
        "analytics": sinks.append(str(tmp_path / "analytics"))}, str(tmp_path / "ck"), every=None)
    for query in started.values():
        query.awaitTermination()
    for name in started:
        assert tables.read(spark, str(tmp_path / name), zoned(ORDER)).count() == 2


def test_one_failing_sink_does_not_stop_the_others(spark, orders, tmp_path):
    def broken(batch, batch_id):
        raise RuntimeError("queue is down")

    orders.push([order(1, 0), order(2, 0)])
    step = sinks.fan_out({
        "log": sinks.append(str(tmp_path / "log")), "queue": broken,
        "invoices": lambda b, n: tables.put(filters.invoices(b), str(tmp_path / "inv"), n)},
        str(tmp_path / "outcomes"))
    drain(orders.stream(), step, tmp_path / "ck")
    schema = T.StructType().add("sink", "string").add("ok", "boolean").add("error", "string")
    seen = tables.read(spark, str(tmp_path / "outcomes"), schema).collect()
    assert sorted((r.sink, r.ok) for r in seen) == [
        ("invoices", True), ("log", True), ("queue", False)]
    assert "queue is down" in [r.error for r in seen if not r.ok][0]
    assert tables.read(spark, str(tmp_path / "log"), zoned(ORDER)).count() == 2
    assert spark.read.parquet(str(tmp_path / "inv")).count() == 2


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    df = spark.createDataFrame([order(1, 0), order(1, 5), order(2, 9)], ORDER)
    path = str(tmp_path / "once")
    step = dedup.accept_once(path, ORDER, ["created_at"])
    for batch_id in (0, 0, 1, 1):
        step(df, batch_id)
    rows = tables.read(spark, path, ORDER).collect()
    assert sorted((r.message_id, r.batch_id, r.created_at) for r in rows) == [
        ("m1", 0, at(0)), ("m2", 0, at(9))]


@pytest.mark.parametrize("split_rows", [100_000, 1])
def test_exact_expiry_over_batches(spark, tmp_path, split_rows):
    schema = T.StructType().add("message_id", "string").add("created_at", T.TimestampNTZType()) \
        .add("offset", "long")
    path = str(tmp_path / "ttl")
    step = dedup.accept_within_ttl(path, schema, ["created_at", "offset"], 100,
                                   split_rows=split_rows)
    batches = [[0, 50], [99, 100, 150], [199, 200, 201], [120, 230], [], [5000]]
    n = 0
    for i, times in enumerate(batches):
        rows = [("m", at(t), n + j) for j, t in enumerate(times)]
        n += len(times)
        step(spark.createDataFrame(rows, schema), i)
        step(spark.createDataFrame(rows, schema), i)
    got = sorted(r.created_at for r in tables.read(spark, path, schema).collect())
    assert got == [at(t) for t in (0, 100, 200, 5000)]


def test_stateful_dedup(spark, orders, tmp_path):
    once = dedup.drop_repeats(orders.stream(), ttl=60)
    out = str(tmp_path / "out")
    for rows in ([order(1, 0), order(2, 1)], [order(1, 30), order(3, 31)]):
        orders.push(rows)
        drain(once, sinks.append(out), tmp_path / "ck")
    got = tables.read(spark, out, once.schema).collect()
    assert sorted(r.message_id for r in got) == ["m1", "m2", "m3"]
    fifo = dedup.drop_fifo_repeats(orders.stream().withColumn("body", F.col("customer_id")))
    drain(fifo, sinks.append(str(tmp_path / "fifo")), tmp_path / "ck2")
    assert tables.read(spark, str(tmp_path / "fifo"), fifo.schema).count() == 1


def test_retry_flow(spark, tmp_path):
    schema = T.StructType().add("message_id", "string").add("heals_at", "integer")
    flow = retry.RetryTables(str(tmp_path / "flow"))
    now = {"t": datetime(2024, 3, 1, tzinfo=timezone.utc)}
    alarms = []
    step = retry.retry_flow(
        flow, schema, F.col("attempt") < F.col("heals_at"), (10, 30, 60),
        clock=lambda b: now["t"],
        on_dead=lambda df, n: alarms.extend(r.message_id for r in df.collect()))
    first = [("ok", 1), ("soon", 2), ("never", 99), ("odd", None)]
    plan = [(0, first), (5, []), (10, []), (39, [("new", 1)]), (40, []), (100, []), (200, [])]
    done = {}
    for n, (t, rows) in enumerate(plan):
        now["t"] = datetime(2024, 3, 1, tzinfo=timezone.utc) + timedelta(seconds=t)
        step(spark.createDataFrame(rows, schema), n)
        before = tables.read(spark, flow.retry, schema).count()
        now["t"] += timedelta(seconds=1000)      # a replay must not look at the clock again
        step(spark.createDataFrame(rows, schema), n)
        assert tables.read(spark, flow.retry, schema).count() == before
        done[t] = retry.pending(spark, flow, schema).count()
    attempts = T.StructType(schema.fields).add("attempt", "integer")
    ok = tables.read(spark, flow.ok, attempts).collect()
    assert sorted((r.message_id, r.attempt, r.batch_id) for r in ok) == [
        ("new", 1, 3), ("odd", 1, 0), ("ok", 1, 0), ("soon", 2, 2)]
    dead = tables.read(spark, flow.dead, attempts)
    assert [(r.message_id, r.attempt, r.batch_id) for r in dead.collect()] == [("never", 4, 5)]
    assert set(alarms) == {"never"}
    assert done == {0: 2, 5: 2, 10: 1, 39: 1, 40: 1, 100: 0, 200: 0}
    again = replay(dead.drop("batch_id"), F.col("message_id") == "never")
    assert again.columns == ["message_id", "heals_at"]


def test_retry_delays_must_be_positive(spark, tmp_path):
    with pytest.raises(ValueError):
        retry.retry_flow(retry.RetryTables(str(tmp_path)), ORDER, F.lit(True), (0,))


def test_idle_stream_with_heartbeat_still_retries(spark, orders, tmp_path):
    flow = retry.RetryTables(str(tmp_path / "flow"))
    schema = zoned(ORDER)
    step = retry.retry_flow(flow, schema, F.col("attempt") < 2, (1,))
    orders.push([order(1, 0)])
    stream = sinks.with_heartbeat(orders.stream(), spark)
    query = sinks.start(stream, step, str(tmp_path / "ck"), every="1 second")
    try:
        for _ in range(30):
            query.awaitTermination(1)
            try:
                if tables.read(spark, flow.ok, schema).count():
                    break
            except Exception:  # noqa: BLE001 - the table appears with the first batch
                pass
    finally:
        query.stop()
    assert tables.read(spark, flow.ok, schema).count() == 1


def test_routing_and_projection_of_a_stream(spark, orders, tmp_path):
    bindings = spark.createDataFrame([("t", "TOPIC", "order.*", "q1"), ("t", "TOPIC", "#", "q2")],
                                     schemas.BINDING)
    stream = orders.stream().withColumns({
        "exchange": F.lit("t"), "routing_key": F.concat(F.lit("order."), F.lower("status"))})
    routed = routing.route(filters.stock_actions(filters.with_status(stream)), bindings)
    orders.push([order(1, 0), order(2, 0, status="SHIPPED")])
    drain(routed, sinks.append(str(tmp_path / "out")), tmp_path / "ck")
    rows = tables.read(spark, str(tmp_path / "out"), routed.schema).collect()
    assert sorted((r.message_id, r.queue, r.stock_action) for r in rows) == [
        ("m1", "q1", "deduct"), ("m1", "q2", "deduct")]


def test_stage_throughput_of_a_stream(spark, orders, tmp_path):
    stages = orders.stream().select(F.lit("placed").alias("stage"), "message_id",
                                    F.col("created_at").alias("ts"))
    out = metrics.stage_throughput(stages)
    orders.push([order(1, 0), order(2, 10), order(3, 61)])
    drain(out, sinks.changelog(str(tmp_path / "o")), tmp_path / "c", "update")
    rows = tables.read(spark, str(tmp_path / "o"), out.schema).collect()
    assert sorted(r.events for r in rows) == [1, 2]


def test_tap_reports_without_changing_rows(spark, orders, tmp_path):
    listener = sinks.ObservedMetrics()
    spark.streams.addListener(listener)
    try:
        orders.push([order(1, 0, amount=2.0), order(2, 0, amount=3.0)])
        tapped = filters.tap(orders.stream(), "passed", F.count(F.lit(1)).alias("n"),
                             F.sum("amount").alias("amount"))
        drain(tapped, sinks.append(str(tmp_path / "o")), tmp_path / "c")
        query = sinks.start(orders.stream(), lambda b, n: None, str(tmp_path / "c2"), every=None)
        query.awaitTermination()
    finally:
        spark.streams.removeListener(listener)
    assert tables.read(spark, str(tmp_path / "o"), zoned(ORDER)).count() == 2
    assert {"n": 2, "amount": 5.0} in [row for _, name, row in listener.seen if name == "passed"]


def test_bounded_poll_and_file_metadata(spark, orders, tmp_path):
    for i in range(3):
        orders.push([order(i, i)])
    sizes = []
    stream = orders.stream(max_files=1, with_metadata=True)
    assert {"source_file", "source_time"} <= set(stream.columns)
    drain(stream, lambda b, n: sizes.append(b.count()), tmp_path / "ck")
    assert sum(sizes) == 3 and max(sizes) == 1
