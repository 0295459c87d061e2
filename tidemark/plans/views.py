"""The given tables as order, payment, routing and metric views.

Each view is a projection of one whole table; the SQL twins are in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import seconds, short_id
from tidemark.operators.skew import running, running_count, running_sum
from tidemark.schemas import BINDING, HEADER_BINDING

COMMITTED_UNTIL = "2024-01-25 00:00:00"
PROCESSED_UNTIL = "2024-01-15 00:00:00"
SCHEMA_CHANGE = "2024-01-16 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_type(default: str | None = None, **values: str) -> Column:
    out = F
    for kind, value in values.items():
        out = out.when(F.col("event_type") == kind, value)
    return out.otherwise(default) if default is not None else out


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _spread(modulus: int) -> Column:
    return (F.col("event_id") * 7919) % modulus


def as_orders(events: DataFrame) -> DataFrame:
    status = _by_type(purchase="PLACED", view="CONFIRMED", click="SHIPPED",
                      signup="DELIVERED", error="CANCELLED")
    items = F.concat(F.lit("item"), (F.col("event_id") % 5).cast("string"),
                     F.lit(", item"), (F.col("event_id") % 3).cast("string"))
    return events.select(
        "event_id", "event_type", _text("event_id").alias("message_id"),
        _text("event_id").alias("order_id"), _text("user_id").alias("customer_id"),
        F.col("value").alias("amount"), items.alias("items"), status.alias("status"),
        F.col("ts").alias("created_at"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_orders(table(spark, sf_dir, "events"))


def as_payments(events: DataFrame) -> DataFrame:
    """Every event but a sign-up is paid, between 45 seconds before and after it."""
    method = F.when(F.col("user_id") % 3 == 0, "UPI") \
              .when(F.col("user_id") % 3 == 1, "CREDIT_CARD").otherwise("WALLET")
    return events.where(F.col("event_type") != "signup").select(
        _text("event_id").alias("order_id"), short_id("PAY", "event_id").alias("payment_id"),
        method.alias("payment_method"),
        F.when(F.col("event_id") % 7 == 0, "FAILED").otherwise("SUCCESS").alias("payment_status"),
        F.col("value").alias("amount"),
        (F.col("ts") + seconds(_spread(91) - 45)).alias("created_at"))


def payment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_payments(table(spark, sf_dir, "events"))


def as_redelivered(orders: DataFrame) -> DataFrame:
    """Orders with further deliveries: errors after 5 s, purchases on both sides of a day."""
    delays = (F.when(F.col("event_type") == "error", F.array(F.lit(0), F.lit(5)))
              .when(F.col("event_type") == "purchase",
                    F.array(*[F.lit(x) for x in (0, 5, 86_399, 86_400, 90_000, 172_800)]))
              .otherwise(F.array(F.lit(0))))
    rows = orders.select("*", F.posexplode(delays).alias("delivery", "_d"))
    return rows.select("message_id", "order_id", "customer_id", "amount",
                       (F.col("created_at") + seconds(F.col("_d"))).alias("created_at"),
                       F.col("delivery").cast("long").alias("delivery"))


def redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_redelivered(order_events(spark, sf_dir))


def queue_messages(events: DataFrame) -> DataFrame:
    """Messages by user, where an error carries its own id and others only a body."""
    own = F.when(F.col("event_type") == "error", F.concat(F.lit("err-"), F.col("user_id") % 20))
    body = F.concat_ws("|", "event_type", F.col("user_id") % 40)
    return events.select("event_id", "ts", own.alias("own_id"), body.alias("body"))


def job_messages(spark: SparkSession, sf_dir: str, exchange: str) -> DataFrame:
    key = _by_type(purchase="order.placed", view="order.item.viewed", click="payment.success",
                   error="payment.failed", signup="inventory.low")
    if exchange == "direct.orders.exchange":
        key = F.when(F.col("event_type") == "purchase", "order.process").otherwise(key)
    return table(spark, sf_dir, "events").select(
        _text("event_id").alias("message_id"), F.lit(exchange).alias("exchange"),
        key.alias("routing_key"), F.col("props").alias("payload"),
        F.create_map(F.lit("type"), F.col("event_type"), F.lit("region"),
                     F.concat(F.lit("R"), (F.col("user_id") % 4).cast("string"))).alias("headers"),
        F.col("ts").alias("created_at"))


# Exchanges, binding keys and queues of the routing example.
BINDINGS = (
    ("direct.orders.exchange", "DIRECT", "order.process", "direct.orders.queue"),
    ("fanout.notifications.exchange", "FANOUT", None, "fanout.notifications.email.queue"),
    ("fanout.notifications.exchange", "FANOUT", None, "fanout.notifications.sms.queue"),
    ("fanout.notifications.exchange", "FANOUT", None, "fanout.notifications.push.queue"),
    ("topic.events.exchange", "TOPIC", "order.*", "topic.orders.queue"),
    ("topic.events.exchange", "TOPIC", "payment.*", "topic.payments.queue"),
)
DEEP_BINDINGS = BINDINGS + (
    ("topic.events.exchange", "TOPIC", "order.#", "topic.orders.queue"),
    ("topic.events.exchange", "TOPIC", "#", "topic.audit.queue"),
    ("topic.events.exchange", "TOPIC", "*.item.*", "topic.items.queue"),
)
HEADER_BINDINGS = (
    ("headers.exchange", {"type": "purchase", "region": "R1"}, "all", "headers.r1.queue"),
    ("headers.exchange", {"type": "error", "region": "R2"}, "any", "headers.watch.queue"),
)


def bindings(spark: SparkSession, rows: tuple = BINDINGS) -> DataFrame:
    return spark.createDataFrame(list(rows), BINDING)


def header_bindings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(HEADER_BINDINGS), HEADER_BINDING)


def user_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages about users, addressed by key and by headers."""
    region = F.concat(F.lit("r"), F.col("user_id") % 4)
    return table(spark, sf_dir, "events").select(
        _text("event_id").alias("message_id"), F.lit("users").alias("exchange"),
        F.concat_ws(".", F.lit("user"), _text("user_id"), region, "event_type").alias("routing_key"),
        F.create_map(F.lit("user"), _text("user_id"), F.lit("type"), F.col("event_type"), F.lit("region"), region).alias("headers"))


def user_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pattern for every user and kind of event, one for every user, and one for every kind."""
    events = table(spark, sf_dir, "events").select(_text("user_id").alias("u"), F.col("event_type").alias("t"))
    each = [("u", "t", F.concat(F.lit("user."), "u", F.lit(".*."), "t"), F.concat(F.lit("alert."), "t")),
            ("u", None, F.concat(F.lit("user."), "u", F.lit(".#")), F.concat(F.lit("shard."), F.col("u").cast("long") % 7)),
            ("t", None, F.concat(F.lit("#."), "t"), F.concat(F.lit("alert."), "t"))]
    parts = [events.select(*[k for k in (a, b) if k]).distinct().select(
        F.lit("users").alias("exchange"), F.lit("TOPIC").alias("exchange_type"), key.alias("binding_key"), queue.alias("queue"))
        for a, b, key, queue in each]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def user_header_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every user and kind of event one binding that asks for both; for every region one that asks for it or for errors."""
    events = table(spark, sf_dir, "events").select(_text("user_id").alias("u"), F.col("event_type").alias("t"))
    both = events.distinct().select(F.create_map(F.lit("user"), "u", F.lit("type"), "t").alias("headers"), F.lit("all").alias("match"),
                                    F.concat(F.lit("shard."), F.col("u").cast("long") % 7).alias("queue"))
    region = F.concat(F.lit("r"), F.col("u").cast("long") % 4)
    either = events.select(region.alias("r")).distinct().select(
        F.create_map(F.lit("region"), "r", F.lit("type"), F.lit("error")).alias("headers"), F.lit("any").alias("match"), F.col("r").alias("queue"))
    return both.unionByName(either).select(F.lit("users").alias("exchange"), "headers", "match", "queue")


def order_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before the schema change."""
    return order_events(spark, sf_dir).where(
        F.col("created_at") < F.lit(SCHEMA_CHANGE).cast("timestamp_ntz")) \
        .select("message_id", "order_id", "customer_id", "amount", "status", "created_at")


def order_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders since the schema change, with the two new fields."""
    email = F.when(F.col("event_id") % 3 != 0,
                   F.concat(F.lit("c"), "customer_id", F.lit("@example.com")))
    return order_events(spark, sf_dir).where(
        F.col("created_at") >= F.lit(SCHEMA_CHANGE).cast("timestamp_ntz")) \
        .select("message_id", "order_id", "customer_id", "amount", "status", "created_at",
                F.concat(F.lit("R"), (F.col("event_id") % 4).cast("string")).alias("region"),
                email.alias("customer_email"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text of orders, some by producers that renamed a field or invented a state."""
    status = F.when(F.col("event_type") == "signup", "REGISTERED").otherwise(F.col("status"))
    renamed = F.col("event_type") == "error"
    record = F.struct("message_id", "order_id", "customer_id",
                      F.when(~renamed, F.col("amount")).alias("amount"),
                      F.when(renamed, F.col("amount")).alias("totalAmount"),
                      status.alias("status"), _text("created_at").alias("created_at"))
    return order_events(spark, sf_dir).select("message_id", F.to_json(record).alias("value"))


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each stage saw of every order: later stages miss some kinds of it."""
    kind = F.col("event_type")
    seen = [("placed", F.lit(True)), ("inventory", F.lit(True)), ("analytics", F.lit(True)),
            ("email", kind != "error"), ("sms", ~kind.isin("error", "click")),
            ("invoice", kind.isin("purchase", "view", "signup")),
            ("duplicates", kind == "error")]
    stages = F.array(*[F.when(cond, F.struct(F.lit(name).alias("stage"), F.lit(i).alias("lag")))
                       for i, (name, cond) in enumerate(seen)])
    return (order_events(spark, sf_dir)
            .select("message_id", "created_at", F.explode(stages).alias("s"))
            .where(F.col("s").isNotNull())
            .select("s.stage", "message_id",
                    (F.col("created_at") + seconds(F.col("s.lag"))).alias("ts")))


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter per event type that restarts after every 500 events."""
    rows = running(table(spark, sf_dir, "events").select("event_id", "event_type", "ts"),
                   ["event_type"], ["ts", "event_id"], {"_n": running_count()})
    return rows.select("event_type", "ts", "event_id",
                       (F.col("_n") % 500).cast("double").alias("value"))


#: Upper bounds of the finite buckets.
BUCKET_BOUNDS = (5.0, 10.0, 25.0, 50.0, 100.0, 250.0)


def bucket_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative bucket counters of values per event type, sampled at every event."""
    bounds = F.array(*[F.lit(b) for b in (*BUCKET_BOUNDS, float("inf"))])
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts", "value", F.explode(bounds).alias("le"))
    inside = F.when(F.col("value") <= F.col("le"), 1).otherwise(0)
    seen = running(rows, ["event_type", "le"], ["ts", "event_id"], {"_n": running_sum(inside)})
    return seen.select("event_type", "le", "ts", "event_id", F.col("_n").cast("double").alias("value"))


def gauge_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.create_map(F.lit("type"), F.col("event_type"), F.lit("instance"),
                          F.concat(F.lit("i"), (F.col("user_id") % 3).cast("string")))
    return table(spark, sf_dir, "events").select(F.lit("order_value").alias("metric"),
                                                 labels.alias("labels"), "ts", "value")


def topic_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of three partitions by user, with offsets from 0."""
    rows = table(spark, sf_dir, "events").select(
        F.lit("orders").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("user_id").alias("key"), "event_id", "ts")
    numbered = running(rows, ["partition"], ["event_id"], {"_n": running_count()})
    return numbered.withColumn("offset", F.col("_n") - 1).drop("_n")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered up to 15 hours after they were sent."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("key"), F.col("event_id").alias("sequence"),
        (F.col("ts") + seconds(_spread(54_000))).alias("delivered_at"))
