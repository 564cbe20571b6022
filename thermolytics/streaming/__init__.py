"""Incremental jobs on Structured Streaming (file sources, availableNow triggers)."""
