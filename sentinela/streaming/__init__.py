"""Structured Streaming: ingest, weekly counts, change audit."""
