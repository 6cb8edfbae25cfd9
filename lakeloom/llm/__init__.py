"""Operators of a training-data pipeline: deduplication, tokens, secrets, packing, language."""
