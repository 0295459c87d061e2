"""Calls into Python and entries of the state store go by groups of ids, not by ids."""

import random

from pyspark.sql import functions as F

from test_keyed import ROWS, at, feed
from tidemark.streaming import keyed, sinks


def run(stream, tmp_path):
    out = []
    query = sinks.start(stream, lambda batch, batch_id: out.extend((batch_id, *r) for r in batch.collect()), str(tmp_path / "c"), every=None)
    query.awaitTermination()
    return out, [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]


def test_first_deliveries_are_spark_s_own_state(spark, tmp_path, monkeypatch):
    """One id has half of the rows, ties in time are broken by number, and a batch brings more rows than are collected at once."""
    monkeypatch.setattr(keyed, "PENDING_ROWS", 40)
    rng = random.Random(7)
    batches = [[(rng.choice(["hot", f"k{rng.randrange(300)}", None]), rng.randrange(10 ** 6), at(rng.randrange(50))) for _ in range(900)] for _ in range(3)]
    batches[1].append(("late", 1, None))
    found, states = run(keyed.keep_once(feed(spark, tmp_path / "in", batches), ["created_at", "n"]), tmp_path)
    want, known = [], set()
    for k, rows in enumerate(batches):
        firsts = {}
        for i, n, t in rows:
            if t is not None and i not in known and (i not in firsts or (t, n) < firsts[i]):
                firsts[i] = (t, n)
        known |= firsts.keys()
        want.extend((k, str(i), n) for i, (t, n) in firsts.items())
    assert sorted((b, str(i), n) for b, i, n, _ in found) == sorted(want)
    assert {s.operatorName for s in states} == {"dedupe"} and states[-1].numRowsTotal == len(known)


def test_expiring_ids_share_their_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "GROUPS", 4)
    rng = random.Random(11)
    batches = [[(f"k{rng.randrange(200)}", 1000 * k + n, at(60 * k + rng.randrange(90))) for n in range(400)] for k in range(3)]
    found, states = run(keyed.keep_within_ttl(feed(spark, tmp_path / "in", batches), ["created_at", "n"], 25), tmp_path)
    want, last = [], {}
    for k, rows in enumerate(batches):
        for i, n, t in sorted(rows, key=lambda r: (r[2], r[1])):
            if i not in last or (t - last[i]).total_seconds() >= 25:
                last[i] = t
                want.append((k, i, n, t))
    assert sorted(r[:3] for r in found) == sorted(w[:3] for w in want)
    assert 0 < max(s.numRowsTotal for s in states) <= 4


def test_waiting_messages_share_entries_and_timers(spark, tmp_path, monkeypatch):
    """Messages of one id and of many, equal ones among them, leave in the first batch whose clock has reached them."""
    monkeypatch.setattr(keyed, "GROUPS", 2)
    rng = random.Random(13)
    batches = [[(rng.choice(["hot", f"k{n}"]), rng.choice([1, 2, 3, 9]), at(100 * k + rng.randrange(100))) for n in range(3000)] for k in range(3)]
    batches.append([("end", 1, at(250)), ("end", 1, at(1000))])
    done = keyed.retry_ladder(feed(spark, tmp_path / "in", batches), F.col("attempt") < F.col("n"), delays=(30, 40), lateness="20 seconds")
    found, states = run(done, tmp_path)
    want, clock = [], [float("-inf")]
    for rows in batches:
        clock.append(max(clock[-1], max((t - at(0)).total_seconds() for _, _, t in rows) - 20))
    for k, rows in enumerate(batches):
        for i, n, t in rows:
            attempt, end = min(n, 3), (t - at(0)).total_seconds() + (0, 30, 70)[min(n, 3) - 1]
            batch = k if n == 1 else next(b for b in range(k, len(clock)) if clock[b] >= end)
            want.append((batch, i, n, attempt, "DEAD" if n > 3 else "OK", end))
    assert sorted((b, i, n, a, s, (f - at(0)).total_seconds()) for b, i, n, _, a, s, f in found) == sorted(want)
    assert 0 < max(s.numRowsTotal for s in states) <= 60


def test_a_timeless_message_moves_no_clock(spark, tmp_path):
    batches = [[("a", 2, at(0)), ("b", 1, None)], [("c", 1, at(5))], [("d", 1, at(500))]]
    done = keyed.retry_ladder(feed(spark, tmp_path / "in", batches, ROWS), F.col("attempt") < F.col("n"), delays=(10,), lateness="0 seconds")
    found, _ = run(done, tmp_path)
    assert sorted(r[:2] for r in found) == [(1, "c"), (2, "d"), (3, "a")]
