"""Operators for large training corpora: cleaning, deduplication, mixing, packing, scoring, search."""
