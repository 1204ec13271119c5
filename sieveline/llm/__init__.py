"""Operators for large text corpora: cleaning, matching, tokenising and packing."""
