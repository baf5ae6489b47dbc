"""Operators for training text: deduplication, quality, private data, mixing, formatting, packing."""
