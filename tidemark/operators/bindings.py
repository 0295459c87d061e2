"""Binding tables of any size: a trie of pattern words, postings of headers, and equi-joins with both.

A message costs what it matches. Binding keys become paths of words, one row per step; a routing key walks
them level by level, at every node through its next word, through ``*`` and through ``#``. A header binding
that asks for all its headers is found by the rarest of them and then tested for the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.session import durable

#: Tables of up to so many rows and bytes are broadcast; it steers the plan only.
BROADCAST_ROWS, BROADCAST_BYTES = 20_000, 16 << 20
#: Larger tables are joined with streams in so many copies, each with its share of the messages.
STREAM_COPIES = 8

_WORDS, _POSITIONS = "array<string>", "array<int>"


def _steps(words: Column) -> Column:
    """A pattern's labels: ``=word``, ``*`` or ``#``; of several ``#`` in a row one is left."""
    single = F.filter(words, lambda w, i: (w != "#") | (i == 0) | (F.get(words, i - 1) != "#"))
    return F.transform(single, lambda w: F.when(w.isin("*", "#"), w).otherwise(F.concat(F.lit("="), w)))


class _Table:
    """Rows to look up by exchange and further keys: broadcast, or in copies for the messages of a stream."""

    def __init__(self, rows: DataFrame, keys: list[str], streaming: bool, broadcast_rows: int):
        size = reduce(lambda a, b: a + b, [F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) + 16 for c in rows.columns])
        count, held = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
        small = count <= broadcast_rows and held <= BROADCAST_BYTES
        self.copies = 1 if small or not streaming else STREAM_COPIES
        rows = rows.withColumnsRenamed({c: f"_t{c}" for c in rows.columns})
        if self.copies > 1:
            rows = rows.withColumn("_tcopy", F.explode(F.sequence(F.lit(0), F.lit(self.copies - 1))))
        self.rows, self.keys = F.broadcast(rows) if small else rows, keys

    def join(self, df: DataFrame, values: list[Column], how: str = "inner", also: Column | None = None) -> DataFrame:
        on = F.lit(True) if also is None else also
        for key, value in zip(self.keys, values):
            on = on & (value == F.col(f"_t{key}"))
        if self.copies > 1:
            on = on & (F.pmod(F.xxhash64("_uid"), F.lit(self.copies)) == F.col("_tcopy"))
        return df.join(self.rows, on, how).drop("_tcopy")


def _trie(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Steps of the wildcard patterns, and the queues at every place where a message can end.

    Places are the paths of patterns, ``key=...`` for exact keys and ``all`` for fan-out.
    """
    words = F.split("binding_key", r"\.")
    wild = (F.col("exchange_type") == "TOPIC") & F.arrays_overlap(words, F.array(F.lit("*"), F.lit("#")))
    fan = F.col("exchange_type") == "FANOUT"
    path = F.when(fan, F.array(F.lit("all"))).when(wild, _steps(words)).otherwise(F.array(F.concat(F.lit("key="), F.col("binding_key"))))
    paths = prepared.where("exchange IS NOT NULL").select("exchange", path.alias("_path"), F.coalesce(wild, F.lit(False)).alias("_wild"), "queue")
    ends = paths.select("exchange", F.array_join("_path", ".").alias("place"), "queue").distinct()
    at = paths.where("_wild").select("exchange", "_path").distinct().select("exchange", "_path", F.posexplode("_path").alias("level", "label"))
    steps = at.groupBy("exchange", "level", F.array_join(F.slice("_path", 1, F.col("level")), ".").alias("node"), "label").agg(
        F.max(F.size("_path") == F.col("level") + 1).alias("ends"), F.max(F.size("_path") > F.col("level") + 1).alias("goes_on"))
    return steps.withColumn("child", F.concat_ws(".", F.when(F.col("level") > 0, F.col("node")), "label")), ends


def _moves(words: Column, at: Column) -> Column:
    """What a message may do at a node where it has read up to the positions ``at``.

    A struct per label with the positions behind it; one node is one row however many ``#`` lie above it.
    """
    unread = F.filter(at, lambda p: p < F.size(words))

    def after(w: Column) -> Column:
        return F.transform(F.filter(unread, lambda p: F.get(words, p) == w), lambda p: p + 1)

    literal = F.transform(F.array_distinct(F.transform(unread, lambda p: F.get(words, p))),
                          lambda w: F.struct(F.concat(F.lit("="), w).alias("label"), after(w).alias("at")))
    star = F.struct(F.lit("*").alias("label"), F.transform(unread, lambda p: p + 1).alias("at"))
    rest = F.struct(F.lit("#").alias("label"), F.sequence(F.array_min(at), F.size(words)).alias("at"))
    return F.concat(literal, F.when(F.size(unread) > 0, F.array(star, rest)).otherwise(F.array(rest)))


def by_pattern(rows: DataFrame, prepared: DataFrame, keep: bool, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows (``_uid``, ``exchange``, ``routing_key``, ...) with each queue of each binding they match.

    With ``keep`` every row also comes once with a null queue. A queue comes once per place.
    """
    steps, ends = (durable(t) for t in _trie(prepared))
    depth = steps.agg(F.max("level")).first()[0]
    finish = _Table(ends, ["exchange", "place"], rows.isStreaming, broadcast_rows)
    words = F.when(F.col("routing_key") == "", F.array().cast(_WORDS)).otherwise(F.split("routing_key", r"\."))
    none = F.array().cast(_POSITIONS)

    def state(place: Column, done: Column, at: Column = none) -> Column:
        return F.struct(place.alias("place"), done.alias("done"), at.alias("at"))

    yes, no = F.lit(True), F.lit(False)
    first = [state(F.lit("all"), yes), F.when(F.col("routing_key").isNotNull(), state(F.concat(F.lit("key="), F.col("routing_key")), yes))]
    if keep:
        first.append(state(F.lit(None).cast("string"), yes))
    if depth is not None:
        first.append(F.when(F.col("routing_key").isNotNull(), state(F.lit(""), no, F.array(F.lit(0)))))
    walk = rows.withColumn("_words", words).withColumn("_state", F.explode(F.array_compact(F.array(*first))))
    for level in range(-1 if depth is None else depth + 1):
        table = _Table(steps.where(F.col("level") == level).drop("level"), ["exchange", "node", "label"], rows.isStreaming, broadcast_rows)
        # Those that have arrived pass by, each with a label of its own that no step has.
        waits = F.array(F.struct(F.concat(F.lit("!"), F.col("_uid")).alias("label"), none.alias("at")))
        tried = walk.withColumn("_move", F.explode(F.when(F.col("_state.done"), waits).otherwise(_moves(F.col("_words"), F.col("_state.at")))))
        met = table.join(tried, [F.col("exchange"), F.coalesce(F.col("_state.place"), F.lit("")), F.col("_move.label")], "left")
        arrived = F.col("_tends") & F.array_contains("_move.at", F.size("_words"))
        onward = F.col("_tgoes_on") & (F.size("_move.at") > 0)
        nexts = F.array(F.when(F.col("_state.done"), state(F.col("_state.place"), yes)),
                        F.when(arrived, state(F.col("_tchild"), yes)), F.when(onward, state(F.col("_tchild"), no, F.col("_move.at"))))
        walk = met.withColumn("_state", F.explode(F.array_compact(nexts))).select(*walk.columns)
    done = walk.where("_state.done")
    return finish.join(done, [F.col("exchange"), F.col("_state.place")], "left" if keep else "inner") \
        .where(F.col("_tqueue").isNotNull() | F.col("_state.place").isNull()) \
        .select(*rows.columns, F.col("_tqueue").alias("queue"))


def _postings(usable: DataFrame) -> DataFrame:
    """One row per binding for all its headers, under the rarest; one per header for any of them."""
    pairs = F.array_sort(F.map_entries("headers"))
    every = usable.where("exchange IS NOT NULL").select("exchange", "_any", pairs.alias("_wants"), "queue").distinct()
    asks = every.where(F.col("_any") | F.forall("_wants", lambda e: e["value"].isNotNull()))
    always = asks.where(~F.col("_any") & (F.size("_wants") == 0)) \
        .select("exchange", F.lit("").alias("name"), F.lit("").alias("value"), F.lit(True).alias("always"), "_wants", "queue")
    each = asks.select("*", F.explode("_wants").alias("_e")).where("_e.value IS NOT NULL")
    flat = each.select("exchange", F.col("_e.key").alias("name"), F.col("_e.value").alias("value"), "_any", "_wants", "queue")
    some = flat.where("_any").select("exchange", "name", "value", F.lit(False).alias("always"), F.slice("_wants", 1, 0).alias("_wants"), "queue")
    share = flat.groupBy("exchange", "name", "value").agg(F.count(F.lit(1)).alias("_n"))
    rarest = flat.where("NOT _any").join(share, ["exchange", "name", "value"]).groupBy("exchange", "_wants", "queue") \
        .agg(F.min(F.struct("_n", "name", "value")).alias("_r"))
    full = rarest.select("exchange", "_r.name", "_r.value", F.lit(False).alias("always"), "_wants", "queue")
    return always.unionByName(some).unionByName(full)


def by_headers(rows: DataFrame, usable: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows (``_uid``, ``exchange``, ``headers``, ...) with each queue of each binding they satisfy."""
    table = _Table(durable(_postings(usable)), ["exchange", "always", "name", "value"], rows.isStreaming, broadcast_rows)

    def probe(name: Column, value: Column, always: bool) -> Column:
        return F.struct(name.alias("name"), value.alias("value"), F.lit(always).alias("always"))

    own = F.transform(F.map_entries("headers"), lambda e: probe(e["key"], e["value"], False))
    probes = F.concat(F.array(probe(F.lit(""), F.lit(""), True)), F.coalesce(own, F.slice(F.array(probe(F.lit(""), F.lit(""), False)), 1, 0)))
    asked = rows.withColumn("_probe", F.explode(probes))
    rest = F.forall("_t_wants", lambda e: F.coalesce(F.try_element_at("headers", e["key"]) == e["value"], F.lit(False)))
    return table.join(asked, [F.col("exchange"), F.col("_probe.always"), F.col("_probe.name"), F.col("_probe.value")], also=rest) \
        .select(*rows.columns, F.col("_tqueue").alias("queue"))


class _Deliver(StatefulProcessor):
    """Gives a message's queues once each, or one null if it has none; keeps no state."""

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        message, queues = None, set()
        for row in rows:
            message = [row[n] for n in self.names] if message is None else message
            queues.add(row["queue"])
        for queue in sorted(queues - {None}) or [None]:
            yield Row(**dict(zip(self.names, message)), queue=queue)

    def close(self) -> None:
        pass


def deliver(found: DataFrame, schema) -> DataFrame:
    """Messages of a stream with their queues, without repeats."""
    names = schema.fieldNames()
    return found.select("_uid", *names, "queue").groupBy("_uid") \
        .transformWithState(_Deliver(names), schema.add("queue", "string"), "append", "None")
