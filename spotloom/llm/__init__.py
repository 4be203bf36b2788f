"""Operators for preparing training text: deduplication, scans, search, sharding and packing."""
