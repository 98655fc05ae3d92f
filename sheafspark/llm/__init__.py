"""Operators for preparing training text: extraction, deduplication, scans, scoring, mixing, search and tokens."""
