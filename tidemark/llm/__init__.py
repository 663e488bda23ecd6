"""Operators for training data: search, dedup, extraction, scans, mixing and packing."""
