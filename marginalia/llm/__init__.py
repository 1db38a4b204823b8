"""Operators for training-data corpora: filters, deduplication, scoring, tokens and packing.

Nothing else in the library imports this subpackage.
"""
