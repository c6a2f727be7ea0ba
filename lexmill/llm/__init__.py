"""Operators of a training-data pipeline: deduplication, search, classification, tokenisation and mixing."""
