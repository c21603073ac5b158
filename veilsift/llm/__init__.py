"""Operators for large training-data pipelines: mixing, extraction, filtering, dedup, search, packing."""
