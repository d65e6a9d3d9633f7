"""Structured Streaming jobs: step ingest, refresh sets, throughput windows."""
