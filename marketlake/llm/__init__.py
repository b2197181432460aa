"""Operators for preparing training data: search, near-duplicates, tokens, scoring, filters and packing.

Nothing else in the library imports this package.
"""
