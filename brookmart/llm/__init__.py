"""Operators of a training-data pipeline: deduplication, filtering, mixing, packing, search."""
