"""Structured Streaming pipelines. They reuse the batch operators unchanged."""
