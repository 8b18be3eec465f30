"""Streaming ingest: the same stages over micro-batches of files."""
