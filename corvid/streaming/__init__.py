"""Structured Streaming jobs: per-batch word count (T01) and stop-list filter."""
