"""Operators for training-data pipelines: scoring, deduplication, search, sharding and packing."""
