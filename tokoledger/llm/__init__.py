"""Operators of a training-data pipeline: deduplication, filters, scoring,
search, tokenization and packing. Nothing else in the library imports this."""
