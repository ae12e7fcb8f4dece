"""Operators of a training-data pipeline: filters, scans, search, near-duplicates, mixing, output."""
