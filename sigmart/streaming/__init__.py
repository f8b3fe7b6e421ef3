"""Structured Streaming forms of the ingestion, join and volume steps."""
