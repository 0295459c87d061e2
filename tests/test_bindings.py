"""Tries of binding keys and postings of headers against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import routing
from tidemark.sources.readers import file_stream
from tidemark.streaming import sinks

WORDS = ["a", "b", "c", "", "*", "#", "x+y"]
MESSAGE = "id int, exchange string, routing_key string"
TAGGED = "id int, exchange string, headers map<string,string>"


def matches(pattern, key):
    """Whether the words of a key fit a pattern, word by word."""
    def fits(p, k):
        if not p:
            return not k
        if p[0] == "#":
            return any(fits(p[1:], k[i:]) for i in range(len(k) + 1))
        return bool(k) and p[0] in ("*", k[0]) and fits(p[1:], k[1:])

    if not {"*", "#"} & set(pattern.split(".")):
        return pattern == key
    return fits(pattern.split("."), key.split(".") if key else [])


def expected(messages, bindings):
    out = set()
    for i, exchange, key in messages:
        for at, kind, pattern, queue in bindings:
            if at != exchange or queue is None or exchange is None:
                continue
            if kind == "FANOUT" or (key is not None and pattern is not None and
                                    (matches(pattern, key) if kind == "TOPIC" else pattern == key)):
                out.add((i, queue))
    return sorted(out)


def table(seed, size):
    rng = random.Random(seed)

    def path(most):
        return ".".join(rng.choice(WORDS) for _ in range(rng.randrange(most + 1)))

    bindings = [(rng.choice("tuvw"), rng.choice(["TOPIC", "TOPIC", "TOPIC", "DIRECT"]), path(5), f"q{rng.randrange(9)}") for _ in range(size)]
    bindings += [("f", "FANOUT", None, "copy"), ("f", "TOPIC", "#", "copy"), ("t", "TOPIC", None, "never"), (None, "TOPIC", "#", "never"),
                 ("t", "TOPIC", "#.#.#.a.#", "many"), ("t", "TOPIC", "#.a.#.b.#", "two")]
    messages = [(i, rng.choice(["t", "u", "v", "w", "f", "z", None]), rng.choice([path(6), path(3), None])) for i in range(150)]
    return bindings, messages + [(1000, "t", "a." * 60 + "b")]


def pairs(df):
    return sorted((r.id, r.queue) for r in df.collect())


@pytest.mark.parametrize("seed,limit", [(1, 20_000), (2, 0)])
def test_walks_equal_brute_force(spark, seed, limit):
    bindings, messages = table(seed, 60)
    rows = spark.createDataFrame(messages, MESSAGE)
    held = spark.createDataFrame(bindings, schemas.BINDING)
    want = expected(messages, bindings)
    assert pairs(routing.route(rows, held, False, 0, limit)) == want
    lost = routing.route(rows, held, True, 0, limit).where("queue IS NULL")
    assert sorted(r.id for r in lost.collect()) == sorted({m[0] for m in messages} - {i for i, _ in want})


@pytest.mark.parametrize("limit,keep", [(20_000, True), (0, False)])
def test_streams_walk_alike_and_keep_equal_messages(spark, tmp_path, limit, keep):
    bindings, messages = table(5, 25)
    messages = messages[:60] + messages[:5]
    spark.createDataFrame(messages, MESSAGE).coalesce(2).write.parquet(str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], MESSAGE).schema, max_files=1)
    routed, out = routing.route(stream, spark.createDataFrame(bindings, schemas.BINDING), keep, 0, limit), []
    sinks.start(routed, lambda batch, _: out.extend((r.id, r.queue) for r in batch.collect()), str(tmp_path / "c"), every=None).awaitTermination()
    want = expected(messages, bindings)
    twice = [p for p in want if p[0] < 5]
    assert sorted(p for p in out if p[1] is not None) == sorted(want + twice)
    none = [m[0] for m in messages if not any(i == m[0] for i, _ in want)]
    assert sorted(i for i, q in out if q is None) == (sorted(none) if keep else [])


def test_hundred_thousand_patterns_of_one_exchange(spark):
    n = 100_000
    patterns = spark.range(n).select(F.lit("t").alias("exchange"), F.lit("TOPIC").alias("exchange_type"),
                                     F.concat(F.lit("user."), F.col("id"), F.lit(".#")).alias("binding_key"),
                                     F.concat(F.lit("q"), F.col("id") % 1000).alias("queue"))
    messages = spark.range(0, n, 50).select(F.col("id").cast("int").alias("id"), F.lit("t").alias("exchange"),
                                            F.concat(F.lit("user."), F.col("id"), F.lit(".paid")).alias("routing_key"))
    routed = routing.route(messages, patterns)
    assert not re.search("collect_(set|list)", routed._jdf.queryExecution().toString())
    assert routed.count() == n // 50
    assert routed.where("queue <> concat('q', id % 1000)").count() == 0


def tagged(seed):
    rng = random.Random(seed)

    def some(values):
        return {k: rng.choice(values) for k in rng.sample("abcd", rng.randrange(4))}

    bindings = [(rng.choice("xy"), some(["1", "2", "2", "2", None]), rng.choice(["all", "any", "ANY", None]), f"q{i % 12}") for i in range(60)]
    messages = [(i, rng.choice(["x", "y", "z", None]), rng.choice([some(["1", "2", None]), None])) for i in range(120)]
    return bindings + [("x", None, "any", "never"), ("x", {"a": "1"}, "any", None), ("x", {}, "all", "every")], messages


def wanted(messages, bindings):
    out = set()
    for i, exchange, headers in messages:
        for at, wants, match, queue in bindings:
            if queue is None or wants is None or at != exchange:
                continue
            held = [v is not None and (headers or {}).get(k) == v for k, v in wants.items()]
            if any(held) if (match or "").lower() == "any" else all(held):
                out.add((i, queue))
    return sorted(out)


@pytest.mark.parametrize("seed,limit", [(1, 20_000), (2, 0)])
def test_postings_equal_brute_force(spark, seed, limit):
    bindings, messages = tagged(seed)
    held, rows = spark.createDataFrame(bindings, schemas.HEADER_BINDING), spark.createDataFrame(messages, TAGGED)
    want = wanted(messages, bindings)
    assert pairs(routing.route_by_headers(rows, held, 0, limit)) == want
    assert pairs(routing.route_by_headers(rows, held)) == want


@pytest.mark.parametrize("limit", [20_000, 0])
def test_postings_on_streams(spark, tmp_path, limit):
    bindings, messages = tagged(7)
    spark.createDataFrame(messages, TAGGED).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], TAGGED).schema)
    routed, out = routing.route_by_headers(stream, spark.createDataFrame(bindings, schemas.HEADER_BINDING), 0, limit), []
    sinks.start(routed, lambda batch, _: out.extend((r.id, r.queue) for r in batch.collect()), str(tmp_path / "c"), every=None).awaitTermination()
    assert sorted(out) == wanted(messages, bindings)


def test_hundred_thousand_header_bindings(spark):
    n = 100_000
    bindings = spark.range(n).select(F.lit("x").alias("exchange"), F.create_map(F.lit("kind"), F.lit("order"), F.lit("user"), F.col("id").cast("string"))
                                     .alias("headers"), F.lit("all").alias("match"), F.concat(F.lit("q"), F.col("id")).alias("queue"))
    messages = spark.range(0, n, 100).select("id", F.lit("x").alias("exchange"), F.create_map(
        F.lit("user"), F.col("id").cast("string"), F.lit("kind"), F.lit("order")).alias("headers"))
    routed = routing.route_by_headers(messages, bindings)
    assert routed.count() == n // 100 and routed.where("queue <> concat('q', id)").count() == 0
