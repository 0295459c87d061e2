"""Sums of doubles against exact fractions."""

import math
import random
import sys
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.functions import exact
from tidemark.operators import aggregates, metrics
from tidemark.operators.skew import running, running_sum

INF, NAN = math.inf, math.nan


def expected(values):
    there = [v for v in values if v is not None]
    if not there:
        return None
    if any(math.isnan(v) for v in there) or (INF in there and -INF in there):
        return NAN
    if INF in there or -INF in there:
        return INF if INF in there else -INF
    total = sum(map(Fraction, there))
    try:
        return float(total)
    except OverflowError:
        return INF if total > 0 else -INF


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def groups():
    rng = random.Random(4)
    tiny, huge = 5e-324, sys.float_info.max
    out = [[], [None], [0.0], [-0.0, 0.0], [1.0, INF], [INF, -INF], [-INF, 1e308], [NAN, 1.0], [1.0, 1e27], [1e-300],
           [tiny], [tiny] * 3, [-tiny, tiny], [huge, huge], [huge, -huge, 1.0], [-huge, -huge], [1e16, 1.0, -1e16],
           [2.0 ** 53, 1.0], [2.0 ** 53, 1.0, tiny], [2.0 ** 53 + 2, 1.0], [0.1] * 10, [1e308, 1e308, -1e308], [2.2250738585072014e-308, -tiny],
           [2.0 ** k for k in range(-1074, 1023, 3)], [-(2.0 ** k) for k in range(-1074, 1024, 24)], [None, 3.5, None, -4.25]]
    for _ in range(150):
        spread = rng.choice([2, 30, 300, 1000])
        out.append([rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randint(-min(spread, 1070), min(spread, 1020)))
                    for _ in range(rng.randint(1, 60))])
    for _ in range(30):
        near = [math.ldexp(rng.getrandbits(53), rng.randint(-5, 5)) for _ in range(20)]
        out.append(near + [-x for x in near[:19]])
    return out


def rows_of(spark, seed):
    rows = [(n, v) for n, g in enumerate(groups()) for v in (g or [None])]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, "g int, v double").repartition(5)


@pytest.mark.parametrize("seed", [1, 2])
def test_sums_equal_fractions_in_any_order(spark, seed):
    want = {n: expected(g) for n, g in enumerate(groups())}
    df = rows_of(spark, seed)
    rows = exact.grouped(df, ["g"], {"s": F.col("v")}, "n", {"c": F.col("v")}, {"m": F.col("v")}).collect()
    assert [r.g for r in rows if not same(r.s, want[r.g])] == [] and len(rows) == len(want)
    for r in rows:
        group = groups()[r.g] or [None]
        assert (r.n, r.c) == (len(group), sum(v is not None for v in group))


def test_a_stream_adds_up_as_a_table_does(spark, tmp_path):
    rows_of(spark, 3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("g int, v double").option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    seen = {}

    def keep(batch, _):
        seen.update({r.g: r.s for r in batch.collect()})

    sums = exact.grouped(stream, ["g"], {"s": F.col("v")})
    sums.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")) \
        .trigger(availableNow=True).start().awaitTermination()
    want = {n: expected(g) for n, g in enumerate(groups())}
    assert [n for n in want if not same(seen[n], want[n])] == []


def test_weights_and_several_sums(spark):
    df = spark.createDataFrame([(1, 0.1, 3), (1, 1e300, 2), (1, None, 5), (2, -1e300, 1)], "k int, v double, w int")
    out = exact.grouped(df, ["k"], {"a": F.col("v"), "b": -F.col("v")}, "n", {"c": F.col("v")}, weight=F.col("w"))
    assert sorted(map(tuple, out.collect())) == [(1, 2e300, -2e300, 10, 5), (2, -1e300, 1e300, 1, 1)]


@pytest.mark.parametrize("split_rows", [5, 10_000])
def test_running_sums_equal_fractions(spark, split_rows):
    rng = random.Random(8)
    values = [rng.choice([1e300, -1e300, 0.1, 1.0, 3e-300, None, 1e16]) for _ in range(60)] + [INF, 1.0]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double").withColumn("k", F.lit(1))
    parts = exact.RunningParts(df, F.col("v"))
    out = running(parts.rows, ["k"], ["i"], {n: running_sum(p) for n, p in parts.sums().items()}, split_rows)
    found = [r.s for r in parts.total(out, "s").orderBy("i").collect()]
    assert all(same(a, expected(values[:n + 1])) for n, a in enumerate(found))


def test_averages_of_any_size(spark):
    t = "TIMESTAMP_NTZ '2024-01-01 00:00:01'"
    df = spark.sql(f"""SELECT {t} AS ts, k, v FROM VALUES ('inf', 1D), ('inf', double('infinity')), ('big', 1D), ('big', 1e27D),
        ('tiny', 1e-300D), ('nan', double('nan')), ('nan', 1D), ('none', null) AS x(k, v)""")
    found = {r.k: r.average for r in aggregates.average_over_time(df, "v", by=("k",)).collect()}
    assert found["inf"] == INF and found["big"] == 5e26 and found["tiny"] == 1e-300
    assert math.isnan(found["nan"]) and found["none"] is None


def test_summary_without_groups_or_rows(spark):
    df = spark.createDataFrame([(1e30,), (1e-30,), (None,)], "d double")
    for precise in (True, False):
        out = metrics.duration_summary(df, "d", exact=precise).first()
        assert (out["count"], out["total"], out["max"]) == (2, 1e30, 1e30)
    empty = metrics.duration_summary(df.where("d > 1e40"), "d").first()
    assert (empty["count"], empty["total"]) == (0, None)


def test_month_from_daily_sketches(spark):
    """Ranks of merged sketches against exact ranks, far beyond the size at which sketches hold all values."""
    df = spark.range(60_000).select(
        (F.expr("id div 30") % 2).alias("k"), F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(id % 30)").alias("ts"),
        ((F.col("id") * 7919) % 60_000).cast("double").alias("d"))
    days = metrics.duration_sketches(df, "d", "1 day", ("k",))
    assert days.count() == 60 and days.agg(F.max(F.length("sketch"))).first()[0] < 40_000
    mine = [[i * 7919 % 60_000 for i in range(60_000) if i // 30 % 2 == k] for k in (0, 1)]
    totals, tops = [sum(m) for m in mine], [max(m) for m in mine]
    for r in metrics.summary_of_sketches(days, ("k",)).collect():
        assert (r["count"], r.total, r.max) == (30_000, totals[r.k], tops[r.k])
        for q, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
            assert abs(sum(x <= r[name] for x in mine[r.k]) / 30_000 - q) < 0.012
