"""Operators for preparing training data: text, near-duplicates, vectors, archives."""
