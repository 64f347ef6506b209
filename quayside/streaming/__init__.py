"""Micro-batch ingestion and publishing with the batch operators."""
