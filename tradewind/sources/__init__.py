"""Readers and writers: parquet model, flat files, dumps, timing logs, generator."""
