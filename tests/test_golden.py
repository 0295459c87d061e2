"""Worked examples with known results."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import columns as fn
from tidemark.operators import (aggregates, contract, dedup, filters, joins, metrics, retry,
                                routing)

T0 = datetime(2024, 3, 1, 12, 0, 0)


def at(s):
    return T0 + timedelta(seconds=s)


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


NINE = [("CUST-001", 1500.0, "PLACED"), ("CUST-002", 2500.0, "PLACED"),
        ("CUST-001", 800.0, "CONFIRMED"), ("CUST-003", 3200.0, "PLACED"),
        ("CUST-002", 1200.0, "PLACED"), ("CUST-001", 4500.0, "PLACED"),
        ("CUST-003", 600.0, "CANCELLED"), ("CUST-004", 2800.0, "PLACED"),
        ("CUST-001", 950.0, "PLACED")]


@pytest.fixture(scope="module")
def nine(spark):
    return spark.createDataFrame(
        [(f"m{i}", f"ORD-{i:03d}", c, a, "Pen, Ink", s, at(i), i)
         for i, (c, a, s) in enumerate(NINE)],
        "message_id string, order_id string, customer_id string, amount double, items string, "
        "status string, created_at timestamp_ntz, event_id long")


def test_nine_orders(nine, spark):
    assert filters.with_status(nine).count() == 7
    counts = aggregates.orders_per_customer(nine)
    assert rows(counts, "customer_id", "order_count") == [
        ("CUST-001", 4), ("CUST-002", 2), ("CUST-003", 2), ("CUST-004", 1)]
    asked = spark.createDataFrame([("CUST-001",), ("CUST-002",), ("CUST-999",)],
                                  "customer_id string")
    assert rows(aggregates.lookup_counts(asked, counts), "customer_id", "order_count") == [
        ("CUST-001", 4), ("CUST-002", 2), ("CUST-999", 0)]
    running = aggregates.running_order_count(nine, ["created_at", "event_id"])
    assert [n for _, n in rows(running, "event_id", "order_count")] == [1, 1, 2, 1, 2, 3, 2, 1, 4]
    assert rows(aggregates.revenue_windows(nine), "total_revenue", "order_count") == [(18050.0, 9)]
    placed = aggregates.revenue_windows(nine, statuses=("PLACED",))
    assert rows(placed, "total_revenue", "order_count") == [(16650.0, 7)]
    newest = aggregates.latest_per_key(nine, "customer_id", ["created_at", "event_id"])
    assert rows(newest, "customer_id", "order_id") == [
        ("CUST-001", "ORD-008"), ("CUST-002", "ORD-004"), ("CUST-003", "ORD-006"),
        ("CUST-004", "ORD-007")]


def test_missing_values_in_orders(spark):
    df = spark.createDataFrame([(None, None, None, at(0)), ("c", None, "PLACED", at(1))],
                               "customer_id string, amount double, status string, "
                               "created_at timestamp_ntz")
    assert rows(aggregates.orders_per_customer(df), "customer_id", "order_count") == [("c", 1)]
    assert filters.with_status(df).count() == 1
    assert rows(aggregates.revenue_windows(df), "total_revenue", "order_count") == [(0.0, 2)]


def test_window_edge(spark):
    df = spark.createDataFrame([(1000.0 * (i + 1), at(5 * i)) for i in range(5)]
                               + [(7.0, at(60))], "amount double, created_at timestamp_ntz")
    out = aggregates.revenue_records(aggregates.revenue_windows(df))
    start = out.orderBy("window_start").collect()
    assert [(r.total_revenue, r.order_count) for r in start] == [(15000.0, 5), (7.0, 1)]
    assert start[1].window_start - start[0].window_start == 60_000
    assert start[0].key == str(start[0].window_start)
    assert start[0].window_end - start[0].window_start == 60_000


ORDERS = [("ORD-001", 0), ("ORD-002", 0), ("ORD-003", 0), ("ORD-004", 100), ("ORD-005", 100)]
PAYMENTS = [("ORD-001", "P1", 15), ("ORD-002", "P2", 31), ("ORD-003", "P3", 30),
            ("ORD-004", "P4", 70), ("ORD-004", "P5", 110)]


@pytest.mark.parametrize("split_rows", [2_000_000, 1])
def test_interval_join(spark, split_rows):
    orders = spark.createDataFrame(
        [(o, "c", 10.0, "x", "PLACED", at(t)) for o, t in ORDERS],
        "order_id string, customer_id string, amount double, items string, status string, "
        "created_at timestamp_ntz")
    payments = spark.createDataFrame(
        [(o, p, "UPI", "SUCCESS", 10.0, at(t)) for o, p, t in PAYMENTS], schemas.PAYMENT_EVENT)
    inner = joins.enrich_orders(orders, payments, "inner", split_rows=split_rows)
    pairs = [("ORD-001", "P1"), ("ORD-003", "P3"), ("ORD-004", "P4"), ("ORD-004", "P5")]
    assert rows(inner, "order_id", "payment_id") == pairs
    assert {r.join_type for r in inner.collect()} == {"INNER_JOIN"}
    left = joins.enrich_orders(orders, payments, "left", split_rows=split_rows)
    assert inner.columns == left.columns == schemas.ENRICHED_ORDER.fieldNames()
    alone = left.where(F.col("join_type") == "LEFT_JOIN")
    assert rows(alone, "order_id", "payment_status", "payment_id") == [
        ("ORD-002", "PENDING", None), ("ORD-005", "PENDING", None)]
    assert left.count() == 6
    assert "joined_at" in joins.enrich_orders(orders, payments, joined_at=True).columns


def test_duplicate_payment(spark):
    df = spark.createDataFrame(
        [("m1", "CUST-001", 1500.0, at(0), 0), ("m2", "CUST-002", 2500.0, at(1), 1),
         ("m2", "CUST-002", 2500.0, at(2), 2)],
        "message_id string, customer_id string, amount double, created_at timestamp_ntz, "
        "offset long")
    order = ["created_at", "offset"]
    assert dedup.first_deliveries(df, order).count() == 2
    assert rows(dedup.duplicate_deliveries(df, order), "message_id", "offset") == [("m2", 2)]
    assert rows(dedup.double_charges(df, order), "customer_id", "naive_total",
                "idempotent_total", "overcharge") == [
        ("CUST-001", 1500.0, 1500.0, 0.0), ("CUST-002", 5000.0, 2500.0, 2500.0)]
    assert aggregates.unique_messages(df).first()[0] == 2


@pytest.mark.parametrize("ttl,times,expected", [
    (86_400, [0, 5, 86_399, 86_400, 90_000, 172_800], [0, 86_400, 172_800]),
    (300, [0, 1, 299, 300, 599, 600, 1000], [0, 300, 600, 1000])])
@pytest.mark.parametrize("split_rows", [100_000, 2])
def test_ttl(spark, ttl, times, expected, split_rows):
    df = spark.createDataFrame([("m", at(t), i, "x") for i, t in enumerate(times)],
                               "message_id string, created_at timestamp_ntz, offset long, "
                               "body string")
    kept = dedup.accepted_within_ttl(df, ["created_at", "offset"], ttl, split_rows=split_rows)
    assert kept.columns == df.columns
    assert sorted(r.created_at for r in kept.collect()) == [at(t) for t in expected]


def test_fifo_prefers_the_explicit_id(spark):
    df = spark.createDataFrame(
        [("a", "x", at(0), 0), ("a", "y", at(1), 1), (None, "x", at(2), 2),
         (None, "x", at(3), 3), (None, "x", at(302), 4)],
        "dedup string, body string, created_at timestamp_ntz, offset long")
    kept = dedup.fifo_accepted(df, ["created_at", "offset"], explicit_id="dedup")
    assert [r[0] for r in sorted(kept.select("offset").collect())] == [0, 2, 4]


BINDINGS = [("d", "DIRECT", "order.process", "direct.orders.queue"),
            ("f", "FANOUT", None, "email"), ("f", "FANOUT", None, "sms"),
            ("f", "FANOUT", None, "push"), ("t", "TOPIC", "order.*", "orders"),
            ("t", "TOPIC", "payment.*", "payments"), ("h", "TOPIC", "order.#", "deep"),
            ("h", "TOPIC", "*.placed", "placed"), ("h", "TOPIC", "#.red", "red"),
            ("h", "TOPIC", "a.#.b", "middle"), ("h", "TOPIC", "a.+.b", "literal"),
            ("t", "TOPIC", "order.placed", "orders")]
MESSAGES = [("d", "order.process"), ("d", "order.other"), ("f", "anything"), ("f", None),
            ("t", "order.placed"), ("t", "order.shipped"), ("t", "payment.success"),
            ("t", "payment.failed"), ("t", "inventory.low"), ("t", "order.item.placed"),
            ("h", "order"), ("h", "order.placed"), ("h", "payment.placed"),
            ("h", "order.item.placed"), ("h", "order.item.color.red"), ("h", "red"),
            ("h", "a.b"), ("h", "a.x.y.b"), ("h", "a.+.b"), ("h", "axb"), ("none", "order.placed")]
ROUTES = [("a.+.b", "literal"), ("a.+.b", "middle"), ("a.b", "middle"), ("a.x.y.b", "middle"),
          ("order", "deep"), ("order.item.color.red", "deep"), ("order.item.color.red", "red"),
          ("order.item.placed", "deep"), ("order.placed", "deep"), ("order.placed", "orders"),
          ("order.placed", "placed"), ("order.process", "direct.orders.queue"),
          ("order.shipped", "orders"), ("payment.failed", "payments"),
          ("payment.placed", "placed"), ("payment.success", "payments"), ("red", "red")]


@pytest.mark.parametrize("limits", [(200, 20_000), (2, 20_000), (2, 1)])
def test_routing(spark, limits):
    bindings = spark.createDataFrame(BINDINGS, schemas.BINDING)
    messages = spark.createDataFrame([(i, e, k) for i, (e, k) in enumerate(MESSAGES)],
                                     "id int, exchange string, routing_key string")
    sent = routing.route(messages, bindings, False, *limits)
    assert sorted((r.routing_key, r.queue) for r in sent.where("exchange <> 'f'").collect()) \
        == ROUTES
    fanned = sent.where("exchange = 'f'").collect()
    assert len(fanned) == 6 and len({(r.id, r.queue) for r in fanned}) == 6
    lost = routing.route(messages, bindings, True, *limits).where("queue is null")
    assert rows(lost, "id") == [(1,), (8,), (9,), (19,), (20,)]
    if limits == (200, 20_000):
        assert rows(routing.unroutable(messages, bindings), "id") == rows(lost, "id")


@pytest.mark.parametrize("limit", [200, 1])
def test_header_routing(spark, limit):
    bindings = spark.createDataFrame(
        [("x", {"type": "pdf", "size": "a4"}, "all", "both"),
         ("x", {"type": "pdf", "size": "a4"}, "any", "either"), ("x", {}, "all", "every"),
         ("x", {}, "any", "never"), ("y", {"type": "pdf"}, "all", "other")],
        schemas.HEADER_BINDING)
    messages = spark.createDataFrame(
        [(1, "x", {"type": "pdf", "size": "a4", "k": "v"}), (2, "x", {"type": "pdf"}),
         (3, "x", {}), (4, "y", {"type": "pdf"})],
        "id int, exchange string, headers map<string,string>")
    sent = routing.route_by_headers(messages, bindings, limit)
    assert rows(sent, "id", "queue") == [
        (1, "both"), (1, "either"), (1, "every"), (2, "either"), (2, "every"), (3, "every"),
        (4, "other")]


@pytest.mark.parametrize("delays,attempts", [
    (retry.AS_CODED, [0, 10, 20, 30]), (retry.AS_DOCUMENTED, [0, 10, 40, 100]),
    (retry.INVENTORY, [0, 5, 20, 50])])
def test_retry_ladder(spark, delays, attempts):
    df = spark.createDataFrame([("bad", True, at(0)), ("good", False, at(0)), ("odd", None, at(0))],
                               "message_id string, should_fail boolean, created_at timestamp_ntz")
    out = retry.retry_schedule(df, F.col("should_fail"), delays)
    bad = out.where("message_id = 'bad'").orderBy("attempt").collect()
    assert [r.attempt_at for r in bad] == [at(t) for t in attempts]
    assert [r.state for r in bad] == ["RETRY"] * 3 + ["DEAD"]
    assert rows(out.where("message_id <> 'bad'"), "message_id", "attempt", "state") == [
        ("good", 1, "OK"), ("odd", 1, "OK")]
    done = out.where("state <> 'RETRY'")
    assert done.count() == df.count()
    assert rows(retry.dead_letter_summary(out, "attempt"), "attempt", "dead_messages") == [(4, 1)]


def test_body_counted_retries(spark):
    df = spark.createDataFrame(
        [("bad", True, 0, at(0)), ("good", False, 0, at(0)), ("late", True, 1, at(0)),
         ("over", True, 5, at(0))],
        "message_id string, should_fail boolean, retry_count int, created_at timestamp_ntz")
    out = retry.body_counted(df, F.col("should_fail"), retry_count="retry_count")
    assert rows(out, "message_id", "retry_count", "attempts", "finished_at", "state") == [
        ("bad", 2, 3, at(4), "DEAD"), ("good", 0, 1, at(0), "OK"), ("late", 2, 2, at(2), "DEAD"),
        ("over", 5, 1, at(0), "DEAD")]
    again = retry.replay(retry.dead_letters(out), F.col("message_id") == "bad",
                         F.lit(at(99)).cast("timestamp_ntz"))
    assert rows(again, "message_id", "retry_count", "created_at") == [("bad", 0, at(99))]
    assert again.columns == ["message_id", "should_fail", "created_at", "retry_count"]


def test_inventory_partitions(spark):
    kinds = ["RESTOCK", "SALE", "RETURN", "SALE", "RESTOCK", "ADJUSTMENT", "RETURN", "SALE",
             "RESTOCK"]
    df = spark.createDataFrame(
        [(f"PROD-{i % 3 + 1:03d}", f"Product {i % 3 + 1}", 10 + i, kinds[i], f"WH-{i % 3 + 1}",
          at(i)) for i in range(9)], schemas.INVENTORY_EVENT)
    fixed = {"PROD-001": 0, "PROD-002": 1, "PROD-003": 2}
    placed = routing.explicit_partition(df, "product_id", fixed, 3)
    assert rows(routing.partition_report(placed, "product_id"), "partition", "events",
                "distinct_keys") == [(0, 3, 1), (1, 3, 1), (2, 3, 1)]
    hashed = routing.explicit_partition(df, "product_id", {}, 3)
    assert routing.keys_per_partition(hashed, "product_id").count() == 3
    for strict in (True, False):
        laid = routing.ordered_by_key(df, "product_id", ["created_at"], 3, strict)
        parts = laid.select(F.spark_partition_id().alias("p"), "product_id", "created_at",
                            F.monotonically_increasing_id().alias("i")).orderBy("i").collect()
        for k in fixed:
            times = [r.created_at for r in parts if r.product_id == k]
            assert times == sorted(times) and len(times) == 3
            if strict:
                assert len({r.p for r in parts if r.product_id == k}) == 1


def test_fifo_group_sequence(spark):
    df = spark.createDataFrame([("CUST-001", f"ORD-{i}", at(i), i) for i in (2, 0, 1)],
                               "customer_id string, order_id string, created_at timestamp_ntz, "
                               "offset long")
    out = routing.group_sequence(df, "customer_id", ["created_at", "offset"])
    assert rows(out, "order_id", "sequence") == [("ORD-0", 1), ("ORD-1", 2), ("ORD-2", 3)]


def test_schema_versions(spark):
    v1 = spark.createDataFrame([("m1", "o1", "CUST-001", 1500.0, "PLACED", "2024-01-01T00:00:00")],
                               schemas.ORDER_V1)
    v2 = spark.createDataFrame(
        [("m2", "o2", "c", 2500.0, "PLACED", "2024-01-01T00:00:00", "SOUTH", "customer@example.com"),
         ("m3", "o3", "c", 1.0, "PLACED", "2024-01-01T00:00:00", None, None)], schemas.ORDER_V2)
    both = contract.merge_versions(v1, v2)
    assert rows(both.where("message_id <> 'm3'"), "message_id", "region", "customer_email",
                "schema_version") == [("m1", "UNKNOWN", None, 1),
                                      ("m2", "SOUTH", "customer@example.com", 2)]
    assert both.where("message_id = 'm3'").first().region is None
    assert contract.downgrade(v2).columns == v1.columns
    good, bad = contract.split_by_contract(
        v1.unionByName(v1.withColumn("status", F.lit("INVALID_STATUS")))
        .unionByName(v1.withColumn("status", F.lit(None).cast("string"))))
    assert good.count() == 1 and bad.count() == 2
    assert {r.reject_reason for r in bad.collect()} == {
        "status is missing", "status is not one of the symbols: INVALID_STATUS"}


def test_audit_finds_a_renamed_field(spark):
    df = spark.createDataFrame(
        [('{"order_id": "1", "totalAmount": 5.0, "status": "PLACED"}',),
         ('{"order_id": "2", "totalAmount": 6.0, "status": "NEW"}',), ("not json",)],
        "value string")
    expected = schemas.T.StructType().add("order_id", "string").add("amount", "double") \
        .add("status", "string")
    found = {(r.field, r.issue): (r.records, r.bad_records)
             for r in contract.audit(df, "value", expected).collect()}
    assert found == {("order_id", "null"): (3, 1), ("amount", "null"): (3, 3),
                     ("status", "null"): (3, 1), ("status", "bad_symbol"): (3, 1),
                     ("totalAmount", "unexpected"): (2, 2)}
    read = contract.decode_json(df, "value", expected)
    assert rows(read.where("_corrupt is not null"), "_corrupt", "order_id") == [("not json", None)]


def test_rename_and_widening(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0), (3.0, 3.0), (4.0, 5.0), (None, None)],
                               "amount double, total double")
    out = contract.merge_renamed(df, "amount", "total")
    assert [(r.total, r.rename_conflict) for r in out.collect()] == [
        (1.0, False), (2.0, False), (3.0, False), (5.0, True), (None, False)]
    text = spark.createDataFrame([("7", "1.5"), ("x", "2"), (None, "z")], "n string, f string")
    kinds = {"n": "bigint", "f": "double"}
    assert [(r.n, r.f, r.incompatible) for r in contract.widen(text, kinds).collect()] == [
        (7, 1.5, []), (None, 2.0, ["n"]), (None, None, ["f"])]
    good, bad = contract.split_by_width(text, kinds)
    assert good.count() == 1 and bad.count() == 2 and bad.dtypes == text.dtypes


def test_frames(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x01abc"),),
                                (bytearray(b"\x01\x00\x00\x00\x01abc"),), (bytearray(b"\x00\x00"),),
                                (bytearray(b"\x00\xff\xff\xff\xff"),)], "value binary")
    out = [tuple(r) for r in df.select(fn.frame_schema_id("value"),
                                       fn.frame_body("value").cast("string")).collect()]
    assert out == [(1, "abc"), (None, "abc"), (None, None), (2 ** 32 - 1, "")]
    back = df.select(fn.frame(fn.frame_body("value"), 258).alias("v")).first().v
    assert bytes(back) == b"\x00\x00\x00\x01\x02abc"


def test_checkout_order(spark):
    df = spark.createDataFrame(
        [("m", "ORD-001", "CUST-001", "a@b.c", "1", 2500.0, "Laptop Stand, USB Hub, Mousepad",
          "PLACED", at(0))], schemas.PLACED_ORDER)
    assert filters.stock_actions(df).first().stock_action == "deduct"
    assert filters.invoices(df).first().invoice_no == "INV-ORD-001"
    assert rows(filters.notifications(df, "checkout"), "channel", "body") == [
        ("email", "Order ORD-001 Confirmed"),
        ("sms", "Order ORD-001 placed for ₹2500.0. Thank you!")]
    assert rows(filters.notifications(df), "channel", "body") == [
        ("email", "Order ORD-001 PLACED"), ("sms", "Your order ORD-001 has been PLACED")]
    assert rows(filters.order_items(df), "position", "item") == [
        (0, "Laptop Stand"), (1, "USB Hub"), (2, "Mousepad")]
    stages = df.select(F.explode(F.array(*[F.lit(s) for s in metrics.STAGES])).alias("stage"))
    total = metrics.stage_reconciliation(stages).first().asDict()
    assert all(total[s] == 1 for s in metrics.STAGES)
    assert all(v == 0 for k, v in total.items() if k.endswith("_missing"))


def test_health_colours(spark):
    df = spark.createDataFrame([(0,), (1,), (9,), (10,)], "n int")
    assert [r[0] for r in df.select(filters.health_colour("n")).collect()] == [
        "green", "yellow", "yellow", "red"]


@pytest.mark.parametrize("split_rows", [2_000_000, 2])
def test_counter_with_reset(spark, split_rows):
    df = spark.createDataFrame([("s", at(15 * i), i, v) for i, v in
                                enumerate([0.0, 10.0, 25.0, 5.0, 15.0])],
                               "series string, ts timestamp_ntz, n int, value double")
    deltas = metrics.counter_deltas(df, ["series"], ["ts", "n"], split_rows=split_rows)
    assert [d for _, d in rows(deltas, "n", "delta")] == [None, 10.0, 15.0, 5.0, 10.0]
    out = metrics.counter_rate(df.withColumn("ts", F.col("ts") - fn.seconds(1)), ["series"],
                               ["ts", "n"], split_rows=split_rows).orderBy("window_start")
    got = out.collect()
    assert sum(r.increase for r in got) == 40.0
    assert got[-1].per_second == pytest.approx(40 / 60)
    assert got[-1].per_minute == pytest.approx(40.0)


def test_bucket_quantiles(spark):
    inf = float("inf")
    data = [("full", 0.1, 50), ("full", 0.5, 90), ("full", 1.0, 100), ("full", inf, 100),
            ("over", 0.1, 50), ("over", 0.5, 90), ("over", 1.0, 100), ("over", inf, 110),
            ("none", 1.0, 0), ("none", inf, 0),
            ("pair", 1.0, 20), ("pair", 1.0, 30), ("pair", inf, 20), ("pair", inf, 30)]
    df = spark.createDataFrame(data, "h string, le double, cum_count long")
    out = {(r.h, r.quantile): r.value for r in metrics.bucket_quantiles(df, by=("h",)).collect()}
    assert out[("full", 0.5)] == pytest.approx(0.1)
    assert out[("full", 0.95)] == pytest.approx(0.75)
    assert out[("full", 0.99)] == pytest.approx(0.95)
    assert out[("over", 0.99)] == 1.0
    assert out[("none", 0.5)] is None
    assert out[("pair", 0.5)] == pytest.approx(0.5)


@pytest.mark.parametrize("split_rows", [2_000_000, 3])
def test_duration_summary(spark, split_rows):
    df = spark.createDataFrame([(float(v % 7),) for v in range(21)] + [(None,)], "d double")
    for exact in (True, False):
        out = metrics.duration_summary(df, "d", exact=exact, split_rows=split_rows).first()
        assert (out["count"], out.total, out.max, out.p50) == (21, 63.0, 6.0, 3.0)
        assert out.p95 == 6.0


def test_sustained_alerts(spark):
    def series(name, flags):
        return [(name, at(60 * i), 1.0 if f else 0.0) for i, f in enumerate(flags)]

    df = spark.createDataFrame(series("long", [0, 1, 1, 1, 0, 1, 1]) + series("short", [1, 1, 0, 1]),
                               "s string, window_end timestamp_ntz, per_second double")
    out = metrics.sustained_alerts(df, ["s"], 0.1, 60)
    assert rows(out, "s", "alert_start", "alert_end", "windows") == [("long", at(60), at(180), 3)]


def test_lag_without_commit(spark):
    log = spark.createDataFrame([("t", 0, 0), ("t", 0, 1), ("t", 1, 4)],
                                "topic string, partition int, offset long")
    commits = spark.createDataFrame([("t", 0, 1)], "topic string, partition int, next_offset long")
    assert rows(metrics.consumer_lag(log, commits), "partition", "lag") == [(0, 1), (1, 5)]


def test_identifiers(spark):
    df = spark.createDataFrame([("00000000-0000-0000-0000-000000000000",), ("nope",)], "id string")
    assert [r[0] for r in df.select(fn.is_uuid("id")).collect()] == [True, False]
    random = df.select(fn.short_id("ORD").alias("i")).collect()
    assert all(r.i.startswith("ORD-") and len(r.i) == 12 and r.i == r.i.upper() for r in random)
    assert len({r.i for r in random}) == 2
    assert df.select(fn.from_epoch_millis(F.lit(1000)).cast("long")).first()[0] == 1
    assert df.select(fn.parse_iso(F.lit("bad"))).first()[0] is None
