"""Reusable data operators: ordered prefixes, checks, layout, refresh, tracking."""
