"""Incremental forms of the sync reports on Structured Streaming."""
