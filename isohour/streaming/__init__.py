"""Structured Streaming forms of ingest, keep-latest and daily aggregation."""
