"""Operators for large-scale training data: rules, deduplication, privacy, tokens, classifiers."""
