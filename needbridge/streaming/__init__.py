"""Incremental intake of submissions with Structured Streaming."""
