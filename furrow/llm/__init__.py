"""Operators for preparing training text: deduplication, filtering, packing, tokenising, archives and search."""
