"""Operators for large text corpora: scans, near-duplicates, mixing, formatting and token output."""
