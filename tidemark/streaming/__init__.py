"""Structured Streaming sinks and the stateful flows that need ``foreachBatch``."""
