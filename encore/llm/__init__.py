"""Operators of a training-data pipeline: scoring, search, filters, deduplication, mixing and token files."""
