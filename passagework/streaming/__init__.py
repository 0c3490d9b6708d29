"""Structured Streaming forms of corpus ingestion and sharding."""
