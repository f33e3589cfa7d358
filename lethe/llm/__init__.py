"""Operators for training-data corpora: screening, deduplication, formatting, tokens, scores."""
