"""Keyed state and upserted tables: edges, replays, and what a batch costs after many."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedup import accepted_within_ttl
from tidemark.sources.readers import file_stream
from tidemark.streaming import keyed, sinks
from tidemark.streaming.upsert import UpsertTable

T0 = datetime(2024, 3, 1)
ROWS = "message_id string, n long, created_at timestamp"


def feed(spark, folder, batches, schema=ROWS):
    """A stream with one micro-batch per list of rows."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return file_stream(spark, str(folder), T.StructType.fromDDL(schema), max_files=1)


def outcome(stream, tmp_path):
    out = []
    sinks.start(stream, lambda batch, batch_id: out.extend((batch_id, *r) for r in batch.collect()),
                str(tmp_path / "c"), every=None).awaitTermination()
    return out


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def test_expiry_equals_batch(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), n, at(n * 4 + rng.randrange(30))) for n in range(300)] + [("a", 1000, None)]
    chunks = [rows[i:i + 75] for i in range(0, 301, 75)]
    found = outcome(keyed.keep_within_ttl(feed(spark, tmp_path / "in", chunks), ["created_at", "n"], 60), tmp_path)
    # A row behind an accepted one of an earlier batch is its duplicate.
    accepted, last = [], {}
    for chunk in chunks:
        for key, n, ts in sorted([r for r in chunk if r[2] is not None], key=lambda r: (r[2], r[1])):
            if key not in last or ts >= last[key] + timedelta(seconds=60):
                last[key] = ts
                accepted.append(n)
    assert sorted(r[2] for r in found) == sorted(accepted)
    whole = spark.createDataFrame(sorted([r for r in rows if r[2]], key=lambda r: r[2]), ROWS)
    again = accepted_within_ttl(whole, ["created_at", "n"], 60).count()
    assert abs(again - len(accepted)) <= 6


def test_exactly_at_expiry_and_ties(spark, tmp_path):
    batches = [[("a", 2, at(0)), ("a", 1, at(0)), ("b", 3, at(59))], [("a", 4, at(59)), ("a", 5, at(60)), ("b", 6, at(118))], [("b", 7, at(119))]]
    found = outcome(keyed.keep_within_ttl(feed(spark, tmp_path / "in", batches), ["created_at", "n"], 60), tmp_path)
    assert sorted(r[:3] for r in found) == [(0, "a", 1), (0, "b", 3), (1, "a", 5), (2, "b", 7)]


def test_state_of_expired_ids_goes(spark, tmp_path):
    batches = [[(f"k{i}", i, at(0)) for i in range(50)], [("x", 1, at(10_000))], [("y", 1, at(20_000))], [("z", 1, at(30_000))]]
    stream = keyed.keep_within_ttl(feed(spark, tmp_path / "in", batches), ["created_at", "n"], 60, lateness="10 seconds")
    query = sinks.start(stream, lambda b, i: b.collect(), str(tmp_path / "c"), every=None)
    query.awaitTermination()
    rows = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(rows) >= 50 and rows[-1] <= 4


def test_first_for_ever(spark, tmp_path):
    batches = [[("a", 2, at(5)), ("a", 1, at(5)), (None, 9, at(1))], [("a", 3, at(0)), ("b", 4, at(100)), (None, 8, at(0))]]
    found = outcome(keyed.keep_once(feed(spark, tmp_path / "in", batches), ["created_at", "n"]), tmp_path)
    assert sorted((r[0], r[2]) for r in found) == [(0, 1), (0, 9), (1, 4)]


def test_retries_wait_for_event_time_and_block_nobody(spark, tmp_path):
    """n is the attempt that succeeds. The clock stands at 0 s, 12 s, 25 s and 1,000 s after the batches."""
    batches = [[("ok", 1, at(0)), ("second", 2, at(0)), ("third", 3, at(0)), ("never", 99, at(0)), ("never", 98, at(1))],
               [("tick", 1, at(12))], [("tick2", 1, at(25))], [("tick3", 1, at(1000)), ("waits", 9, at(1000))]]
    stream = feed(spark, tmp_path / "in", batches)
    done = keyed.retry_ladder(stream, F.col("attempt") < F.col("n"), delays=(10, 10, 10), lateness="0 seconds")
    found = outcome(done, tmp_path)
    got = sorted((r[1], r[2], r[4], r[5], (r[6] - T0).total_seconds()) for r in found)
    assert got == [("never", 98, 4, "DEAD", 31.0), ("never", 99, 4, "DEAD", 30.0), ("ok", 1, 1, "OK", 0.0), ("second", 2, 2, "OK", 10.0),
                   ("third", 3, 3, "OK", 20.0), ("tick", 1, 1, "OK", 12.0), ("tick2", 1, 1, "OK", 25.0), ("tick3", 1, 1, "OK", 1000.0)]
    batch = {(r[1], r[2]): r[0] for r in found}
    assert batch["ok", 1] == 0 < batch["second", 2] < batch["third", 3] < batch["never", 99]
    with pytest.raises(ValueError):
        keyed.retry_ladder(stream, F.lit(True), delays=(10, 0))


SCHEMA = T.StructType().add("k", T.StringType()).add("v", T.LongType())


def test_reads_cost_the_same_after_many_batches(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=4, fold=4)
    assert table.read().count() == 0
    want, files = {}, {}
    rng = random.Random(5)
    for batch in range(26):
        rows = {rng.choice([None, *"abcdefghij"]): batch * 100 + i for i in range(4)}
        table.put(spark.createDataFrame(list(rows.items()), SCHEMA), batch)
        want |= rows
        files[batch] = len(table.read().inputFiles())
    assert dict(map(tuple, table.read().collect())) == want
    assert max(files.values()) <= 4 + 4 * 4 and files[25] <= max(files[b] for b in range(1, 9))
    folders = [p for kind in ("base", "delta") for p in (tmp_path / "t" / kind).iterdir()]
    assert len(folders) <= 12 and len(list((tmp_path / "t" / "manifest").glob("[0-9]*"))) <= 3


def test_replays_and_lookups(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=8, fold=3)
    old = table.read
    for batch in range(5):
        rows = spark.createDataFrame([("a", batch), (f"k{batch}", batch), (None, -batch)], SCHEMA)
        before = old()
        table.put(rows, batch)
        table.put(spark.createDataFrame([("a", 777)], SCHEMA), batch)  # delivered again: known
        table.put(spark.createDataFrame([("a", 778)], SCHEMA), 0)
        assert before.count() >= 0  # a reader of the manifest before still finds its folders
    assert sorted(map(tuple, table.lookup([("a",), ("k1",), ("none",)]).collect())) == [("a", 4), ("k1", 1)]
    plan = table.lookup([("a",)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert dict(map(tuple, table.read().collect()))[None] == -4


def test_a_broken_off_put_is_written_anew(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), SCHEMA, ["k"])
    table.put(spark.createDataFrame([("a", 1)], SCHEMA), 0)
    publish = table._publish
    table._publish = lambda manifest: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        table.put(spark.createDataFrame([("a", 2)], SCHEMA), 1)
    assert [tuple(r) for r in table.read().collect()] == [("a", 1)]
    table._publish = publish
    table.put(spark.createDataFrame([("a", 3)], SCHEMA), 1)
    assert [tuple(r) for r in table.read().collect()] == [("a", 3)]
