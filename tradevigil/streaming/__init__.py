"""Structured Streaming ingest of landed files."""
