"""Operators for preparing training data: filters, deduplication, packing, tokens, archives."""
