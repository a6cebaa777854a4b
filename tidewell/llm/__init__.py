"""Operators of a training-data pipeline: archives, quality, deduplication, mixing and packing."""
