"""Operators for building training data: deduplication, filtering, scoring, packing and token files.

Nothing else in the library imports this subpackage.
"""
