"""Operators for large text corpora: quality, deduplication, extraction, tokens and packing."""
