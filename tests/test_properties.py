"""Laws that hold for any input, on seeded random data."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import aggregates, contract, dedup, retry, routing, skew

T0 = datetime(2024, 3, 1)
ORDER = ["created_at", "offset"]


@pytest.fixture(scope="module", params=[1, 2])
def deliveries(spark, request):
    rnd = random.Random(request.param)
    return spark.createDataFrame(
        [(f"m{rnd.randrange(60)}", f"c{rnd.randrange(5)}",
          rnd.choice([None, round(rnd.random() * 100, 2)]),
          rnd.choice(["PLACED", "NEW", None, "SHIPPED"]),
          T0 + timedelta(seconds=rnd.randrange(5000)), i, rnd.random() < 0.4)
         for i in range(300)],
        "message_id string, customer_id string, amount double, status string, "
        "created_at timestamp_ntz, offset long, should_fail boolean")


def test_dedup_twice_is_dedup_once(deliveries):
    once = dedup.first_deliveries(deliveries, ORDER)
    assert sorted(once.collect()) == sorted(dedup.first_deliveries(once, ORDER).collect())
    for ttl in (30, 1000):
        kept = dedup.accepted_within_ttl(deliveries, ORDER, ttl)
        again = dedup.accepted_within_ttl(kept, ORDER, ttl)
        assert sorted(r.offset for r in kept.collect()) == sorted(r.offset for r in again.collect())


def test_first_and_duplicates_are_everything(deliveries):
    first = dedup.first_deliveries(deliveries, ORDER)
    rest = dedup.duplicate_deliveries(deliveries, ORDER)
    assert first.count() + rest.count() == deliveries.count()
    assert first.select("offset").join(rest.select("offset"), "offset").count() == 0


def test_an_endless_memory_is_first_delivery(deliveries):
    kept = dedup.accepted_within_ttl(deliveries, ORDER, 10_000_000)
    first = dedup.first_deliveries(deliveries, ORDER)
    assert sorted(r.offset for r in kept.collect()) == sorted(r.offset for r in first.collect())


def test_retries_lose_nothing(deliveries):
    out = retry.retry_schedule(deliveries, F.col("should_fail"))
    ends = out.where(F.col("state") != "RETRY")
    assert sorted(r.offset for r in ends.collect()) == list(range(300))
    dead = ends.where("state = 'DEAD'")
    assert dead.count() == deliveries.where("should_fail").count()


def test_fanout_reaches_every_queue(spark, deliveries):
    queues = [("x", "FANOUT", None, f"q{i}") for i in range(4)]
    messages = deliveries.select("offset", F.lit("x").alias("exchange"),
                                 F.col("status").alias("routing_key"))
    sent = routing.route(messages, spark.createDataFrame(queues, schemas.BINDING))
    assert sent.count() == 300 * 4 == sent.distinct().count()


def test_contract_split_is_complete(deliveries):
    good, bad = contract.split_by_contract(deliveries)
    assert good.count() + bad.count() == 300
    assert good.where(~F.col("status").isin(*schemas.ORDER_STATUSES)).count() == 0


def test_windows_add_up(deliveries):
    total = deliveries.agg(F.sum(F.col("amount").cast("decimal(18,2)")).cast("double")).first()[0]
    one = aggregates.revenue_windows(deliveries).agg(F.sum("total_revenue"), F.sum("order_count"))
    assert one.first()[1] == 300 and one.first()[0] == pytest.approx(total)
    hops = aggregates.revenue_windows(deliveries, "5 minutes", "1 minute")
    assert hops.agg(F.sum("order_count")).first()[0] == 5 * 300


def test_any_aggregate_can_be_windowed(deliveries):
    out = aggregates.windowed(deliveries, {"top": F.max("amount"),
                                           "customers": F.count_distinct("customer_id")},
                              "1 hour", by=("status",))
    assert out.columns == ["window_start", "window_end", "status", "top", "customers"]
    assert out.agg(F.max("top")).first()[0] == deliveries.agg(F.max("amount")).first()[0]


def test_splitting_does_not_change_results(deliveries):
    want = {"n": skew.running_count(), "m": skew.running_max(F.col("amount"))}
    plain = skew.running(deliveries, ["customer_id"], ORDER, want)
    split = skew.running(deliveries, ["customer_id"], ORDER, want, split_rows=10)
    pick = ["offset", "n", "m"]
    assert sorted(map(tuple, plain.select(pick).collect()), key=str) == sorted(
        map(tuple, split.select(pick).collect()), key=str)
