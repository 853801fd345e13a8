"""Operators for preparing training text: scans, near-duplicates, filters, mixing, tokens, page text."""
