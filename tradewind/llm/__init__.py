"""Operators that prepare training data: dedup, scans, scoring, formatting, mixing and packing."""
