"""Operators for training-data pipelines: filtering, deduplication, privacy, tokens, archives."""
