"""Late rows, sinks that fail, and alerts over cut time lines."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from tidemark.operators import metrics
from tidemark.streaming import sinks, tables
from tidemark.streaming.late import split_late
from tidemark.streaming.outbox import Outbox

T0 = datetime(2024, 3, 1)
ROWS = "id int, ts timestamp"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def ids(spark, path):
    return sorted((r.id, r.batch_id) for r in tables.read(spark, path, T.StructType.fromDDL(ROWS)).collect())


@pytest.mark.parametrize("grace,late", [(0, [(3, 0), (4, 1), (6, 2)]), (10, [(3, 0), (6, 2)])])
def test_late_rows_and_replays(spark, tmp_path, grace, late):
    batches = [[(1, at(0)), (2, at(20)), (3, None)], [(4, at(10)), (5, at(20))], [], [(7, at(50)), (6, at(-100))]]
    batches = batches[:2] + [batches[3], []]
    ok, bad, marks = (str(tmp_path / n) for n in ("ok", "bad", "marks"))
    step = split_late(sinks.append(ok), sinks.append(bad), marks, "ts", grace)
    for n, rows in enumerate(batches):
        for _ in range(2):
            step(spark.createDataFrame(rows, ROWS), n)
    assert ids(spark, bad) == late
    everything = sorted((r[0], n) for n, rows in enumerate(batches) for r in rows)
    assert sorted(ids(spark, ok) + ids(spark, bad)) == everything
    step(spark.createDataFrame([(8, at(40))], ROWS), 4)  # the empty batch before it keeps the mark
    assert ((8, 4) in ids(spark, bad)) == (grace == 0)


def test_a_failed_sink_gets_every_row_once(spark, tmp_path):
    calls, path = [], str(tmp_path / "box")

    def flaky(batch, n):
        calls.append(n)
        sinks.append(str(tmp_path / "a"))(batch, n)
        if len(calls) in (1, 2):
            raise OSError("away")

    writers = {"a": flaky, "b": sinks.append(str(tmp_path / "b"))}
    box = Outbox(spark, path, T.StructType.fromDDL(ROWS), writers)
    for n in range(2):
        box.put(spark.createDataFrame([(n, at(n)), (n, at(n))], ROWS), n)
        assert "away" in box.failures["a"] and box.waiting() == list(range(n + 1))
    assert (box.position("a"), box.position("b")) == (-1, 1)
    box = Outbox(spark, path, T.StructType.fromDDL(ROWS), writers)  # as after a restart
    box.put(spark.createDataFrame([(1, at(1)), (1, at(1))], ROWS), 1)  # a replayed batch
    assert not box.failures and not box.waiting() and calls == [0, 0, 0, 1]
    box.put(spark.createDataFrame([(9, at(9))], ROWS), 1)  # known to all sinks
    assert ids(spark, str(tmp_path / "a")) == ids(spark, str(tmp_path / "b")) == [(0, 0), (0, 0), (1, 1), (1, 1)]


@pytest.mark.parametrize("off_grid", [False, True])
def test_alerts_do_not_depend_on_blocks(spark, off_grid):
    rng = random.Random(4)
    rows = [(s, at(60 * n + (rng.choice([0, 0, 0, 30]) if off_grid else 7)), float(rng.random() < 0.85) * rng.random() + 0.0)
            for s in ("x", None) for n in range(400) if rng.random() < 0.97]
    rates = spark.createDataFrame([*rows, ("x", None, 1.0), ("long", at(0), 1.0)] + [("long", at(60 * n), 1.0) for n in range(1, 300)],
                                  "s string, window_end timestamp, per_second double")

    def alerts(block_rows):
        return sorted(map(repr, metrics.sustained_alerts(rates, ["s"], 0.1, 60, block_rows=block_rows).collect()))

    whole = alerts(1_000_000_000)
    assert len(whole) > 10 and any("windows=300" in r for r in whole)
    assert alerts(1) == alerts(3) == alerts(50) == whole
