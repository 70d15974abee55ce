"""Structured Streaming jobs: topic/file sources, idempotent micro-batch sinks."""
