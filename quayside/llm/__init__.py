"""Operators for training-data corpora: duplicates, filters, scores, mixes and token files."""
