"""Hot keys give the same results as brute force, whatever their distribution."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, joins, routing, skew

T0 = datetime(2024, 3, 1)


def shapes():
    rnd = random.Random(5)
    even = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(30)}", rnd.randrange(100_000))
            for _ in range(900)]
    burst = [("hot" if i % 3 == 0 else f"k{i % 7}", 500 if i % 3 == 0 else i) for i in range(900)]
    nulls = [(None if i % 2 else "k", None if i % 11 == 0 else rnd.randrange(50))
             for i in range(600)]
    return {"even": even, "burst": burst, "nulls": nulls}


def frame(spark, data):
    return spark.createDataFrame(
        [(k, None if t is None else T0 + timedelta(seconds=t), i, float(i % 17))
         for i, (k, t) in enumerate(data)],
        "key string, ts timestamp_ntz, id long, v double").repartition(5)


@pytest.mark.parametrize("shape", ["even", "burst", "nulls"])
def test_running_values(spark, shape):
    data = shapes()[shape]
    df = frame(spark, data)
    out = skew.running(df, ["key"], ["ts", "id"], {
        "n": skew.running_count(), "s": skew.running_sum(F.col("v").cast("decimal(18,2)")),
        "p": skew.previous(F.col("id"))}, split_rows=40)
    assert out.columns == df.columns + ["n", "s", "p"]
    got = {r.id: (r.n, float(r.s), r.p) for r in out.collect()}
    want, state = {}, {}
    for i, (k, t) in sorted(enumerate(data), key=lambda x: (x[1][1] is not None, x[1][1] or 0,
                                                            x[0])):
        n, s, p = state.get(k, (0, 0.0, None))
        n, s = n + 1, s + float(i % 17)
        want[i] = (n, s, p)
        state[k] = (n, s, i)
    assert got == want


@pytest.mark.parametrize("shape", ["even", "burst", "nulls"])
def test_chunks_are_bounded_and_ordered(spark, shape):
    df = frame(spark, shapes()[shape])
    chunked, bound = skew.chunk_hot(df, ["key"], ["ts", "id"], 40)
    cells = chunked.where("_chunk >= 0").groupBy("key", "_chunk").agg(
        F.count("*").alias("n"), F.min(F.struct("ts", "id")).alias("lo"),
        F.max(F.struct("ts", "id")).alias("hi"))
    found = cells.collect()
    assert len(found) <= bound and len(found) > 3
    floor = 55 if shape == "nulls" else 0   # one missing timestamp cannot be cut by time
    assert max(r.n for r in found) <= max(80, floor)
    by_key = {}
    for r in sorted(found, key=lambda r: (r.key or "", r._chunk)):
        by_key.setdefault(r.key, []).append(r)
    for cellsof in by_key.values():
        edges = [((c.ts is not None, c.ts or T0, c.id)) for r in cellsof for c in (r.lo, r.hi)]
        assert edges == sorted(edges)
    assert chunked.where("_chunk < 0").groupBy("key").count().where("count > 40").count() == 0


def test_no_hot_key_means_a_plain_plan(spark):
    df = frame(spark, shapes()["even"])
    assert skew.chunk_hot(df, ["id"], ["ts"], 40) is None
    plan = skew.running(df, ["key"], ["ts", "id"], {"n": skew.running_count()})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text


def ttl_by_hand(data, ttl):
    kept, last = [], {}
    for i, (k, t) in sorted(enumerate(data), key=lambda x: (x[1][1], x[0])):
        if k not in last or t >= last[k] + ttl:
            last[k] = t
            kept.append(i)
    return sorted(kept)


@pytest.mark.parametrize("ttl", [50, 1_000, 30_000])
@pytest.mark.parametrize("shape", ["even", "burst"])
def test_ttl_of_hot_ids(spark, shape, ttl):
    data = shapes()[shape]
    df = frame(spark, data)
    kept = dedup.accepted_within_ttl(df, ["ts", "id"], ttl, "key", split_rows=40)
    assert sorted(r.id for r in kept.collect()) == ttl_by_hand(data, ttl)


def test_ttl_chains_that_never_fall_in_step(spark):
    data = [("hot", 10 * i) for i in range(400)]
    df = frame(spark, data)
    kept = dedup.accepted_within_ttl(df, ["ts", "id"], 30, "key", split_rows=90)
    assert sorted(r.id for r in kept.collect()) == ttl_by_hand(data, 30)


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
@pytest.mark.parametrize("include_end", [True, False])
def test_interval_join_of_hot_keys(spark, how, include_end):
    rnd = random.Random(3)
    left = [("hot" if rnd.random() < 0.5 else f"k{i % 20}", rnd.randrange(-400, 2000), i)
            for i in range(300)]
    right = [("hot" if rnd.random() < 0.5 else f"k{i % 25}", rnd.randrange(-400, 2000), i)
             for i in range(300)]
    ldf = spark.createDataFrame([(k, T0 + timedelta(seconds=t), i) for k, t, i in left],
                                "key string, lt timestamp_ntz, l int")
    rdf = spark.createDataFrame([(k, T0 + timedelta(seconds=t), i) for k, t, i in right],
                                "key string, rt timestamp_ntz, r int")
    ldf = ldf.unionByName(ldf.limit(1).select(F.lit(None).cast("string").alias("key"), "lt",
                                              F.lit(-1).alias("l")))
    left.append((None, 0, -1))
    out = joins.interval_join(ldf, rdf, "key", "lt", "rt", 20, 7, how, include_end, split_rows=50)
    pairs = [(a[2], b[2]) for a in left for b in right if a[0] == b[0]
             and a[1] - 20 <= b[1] and (b[1] <= a[1] + 7 if include_end else b[1] < a[1] + 7)]
    matched = {p[0] for p in pairs}
    alone = [a[2] for a in left if a[2] not in matched]
    if how == "inner":
        assert sorted((r.l, r.r) for r in out.collect()) == sorted(pairs)
    elif how == "left":
        want = pairs + [(x, None) for x in alone]
        assert sorted(((r.l, r.r) for r in out.collect()), key=str) == sorted(want, key=str)
    else:
        want = sorted(matched) if how == "left_semi" else sorted(alone)
        assert sorted(r.l for r in out.collect()) == want


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_interval_existence_in_a_burst(spark, how):
    ldf = spark.createDataFrame([(None if i % 2 else "hot", T0 + timedelta(seconds=i // 100), i)
                                 for i in range(400)], "key string, lt timestamp_ntz, l int")
    rdf = spark.createDataFrame([("hot", T0 + timedelta(seconds=2))] * 200
                                + [(None, T0)] * 200, "key string, rt timestamp_ntz")
    out = joins.interval_join(ldf, rdf, "key", "lt", "rt", 0, 1, how, split_rows=50)
    assert out.columns == ldf.columns
    hits = {i for i in range(400) if i % 2 == 0 and 1 <= i // 100 <= 2}
    want = hits if how == "left_semi" else set(range(400)) - hits
    assert {r.l for r in out.collect()} == want and out.count() == len(want)


def test_membership_with_a_hot_processed_id(spark):
    seen = spark.createDataFrame([("a",)] * 60 + [("b",), ("c",)], "message_id string")
    sent = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("d", 4), (None, 5)],
                                 "message_id string, n int")
    old = joins.already_processed(sent, seen, split_rows=20)
    new = joins.not_yet_processed(sent, seen, split_rows=20)
    assert sorted(r.n for r in old.collect()) == [1, 2, 3]
    assert sorted(r.n for r in new.collect()) == [4, 5]


def test_order_violations_across_chunks(spark):
    rnd = random.Random(9)
    data = [("hot" if i % 2 else f"k{i % 9}", i + rnd.randrange(30)) for i in range(500)]
    df = frame(spark, data)
    out = routing.order_violations(df, "key", ["ts", "id"], "id", split_rows=40)
    last, want = {}, []
    for i, (k, t) in sorted(enumerate(data), key=lambda x: (x[1][1], x[0])):
        if k in last and i < last[k]:
            want.append(i)
        last[k] = i
    assert sorted(r.id for r in out.collect()) == sorted(want)


def test_first_delivery_limits_before_the_shuffle(spark):
    df = frame(spark, shapes()["even"])
    plan = dedup.first_deliveries(df, ["ts", "id"], "key")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in text and "WindowGroupLimit" in text


@pytest.mark.parametrize("kind", [skew.running_sum, skew.previous])
def test_tasks_of_cut_keys_hold_bounded_rows(spark, monkeypatch, kind):
    monkeypatch.setattr(skew, "TASK_ROWS", 100, raising=False)
    keys = [0.0, -0.0, 2.5, float("inf"), float("nan"), None]
    rows = [(keys[i % 6], T0 + timedelta(seconds=i // 3), i, i % 11) for i in range(6000)]
    df = spark.createDataFrame(rows, "k double, ts timestamp_ntz, id long, v long")
    cut = skew.running(df, ["k"], ["ts", "id"], {"r": kind(F.col("v"))}, split_rows=100)
    plain = skew.running_plain(df, ["k"], ["ts", "id"], {"r": kind(F.col("v"))})
    assert cut.columns == plain.columns
    assert {r["id"]: r["r"] for r in cut.collect()} == {r["id"]: r["r"] for r in plain.collect()}
    tasks = cut.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 30 and max(r["count"] for r in tasks) <= 600
