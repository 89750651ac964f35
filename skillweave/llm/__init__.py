"""Operators for building training data: quality, toxicity, deduplication, archives, packing, extraction, formatting.

Nothing else in the library imports this subpackage. Queries over the given tables are in ``queries``.
"""
