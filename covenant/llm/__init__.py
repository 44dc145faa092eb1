"""Operators for building training corpora: search, scoring, packing, deduplication, archives, chat and language."""
