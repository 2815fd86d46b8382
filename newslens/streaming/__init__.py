"""Structured Streaming ingest (per micro-batch, or per completed half-day window)."""
