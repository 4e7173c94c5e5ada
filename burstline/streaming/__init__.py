"""Structured Streaming forms of ingest, counting and trend ranking."""
