"""Operators for preparing training data: dedup, classifiers, tokens, packing."""
