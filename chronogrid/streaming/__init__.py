"""Incremental processing with Structured Streaming.

The reference processes new data in batches, chunk by chunk, after extending
the axis.  Here new hourly files are picked up by a file stream and inserted
with the idempotent region write, optionally followed by the daily reduction
of the touched days.
"""
