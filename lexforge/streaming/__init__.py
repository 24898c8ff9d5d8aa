"""Additive ingest by Structured Streaming."""
