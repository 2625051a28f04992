"""Operators for training-data pipelines: dedup, filters, mixing, packing, search."""
