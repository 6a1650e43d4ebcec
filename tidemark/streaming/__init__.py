"""Structured Streaming: sinks, counters and the table-by-table runner."""
