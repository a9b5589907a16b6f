"""Operators for text corpora: counting, extraction, cleaning, deduplication,
mixing and archiving.  Nothing outside this package imports it."""
