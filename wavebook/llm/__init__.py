"""Operators for preparing training data: packing, deduplication, filtering, archives, search."""
