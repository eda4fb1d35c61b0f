"""Incremental loads on Structured Streaming (file source, availableNow, foreachBatch)."""
