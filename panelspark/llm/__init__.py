"""Operators for preparing training text: filters, near-duplicates, contamination, tokens, shards."""
