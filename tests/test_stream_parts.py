"""Registered streaming queries see their input in several micro-batches."""

from tidemark.operators import aggregates
from tidemark.plans import catalog, views
from tidemark.session import scratch
from tidemark.streaming import sinks, tables

SF = "/root/testdata/sf0.001"


def test_parts_become_batches_and_state_goes_on(spark):
    events, parts = catalog._event_stream(spark, SF)
    counts = aggregates.orders_per_customer(views.as_orders(events))
    out = scratch(spark)
    catalog._drain(counts, sinks.changelog(out), parts, "update")
    changes = tables.read(spark, out, counts.schema)
    assert changes.select(tables.BATCH).distinct().count() == catalog.STREAM_PARTS
    newest = tables.latest(spark, out, counts.schema, "customer_id")
    total = next(c for c, kind in newest.dtypes if kind == "bigint")
    assert newest.agg({total: "sum"}).first()[0] == views.table(spark, SF, "events").count()
