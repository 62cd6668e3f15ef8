"""Operators for training-data pipelines: mixing, search, filters, fingerprints, deduplication, language models."""
