"""Structured Streaming: load-once file ingestion."""
