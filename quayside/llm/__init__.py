"""Operators for large training corpora: search, tokenising, dedup, mixing, filtering."""
