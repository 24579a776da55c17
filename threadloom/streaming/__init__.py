"""Incremental document loading with Structured Streaming."""
