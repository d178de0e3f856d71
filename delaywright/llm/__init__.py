"""Operators of a training-data pipeline: cleaning, deduplication, scoring, encoding, packing."""
