"""Operators of a training-data pipeline: extraction, deduplication, search, tokens, private data, mixing, filters."""
