"""Operators for large training-text corpora (dedup, scoring, rules, packing)."""
