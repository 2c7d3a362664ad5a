"""Operators for preparing training data: archives, tokens, filters, duplicates, packing."""
