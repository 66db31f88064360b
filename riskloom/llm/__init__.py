"""Operators of a training-data pipeline: archives, tokens, deduplication, filters and packing on Spark."""
