"""Operators for preparing training text: filters, near-duplicates, scans, archives, tokens, shards, language models."""
