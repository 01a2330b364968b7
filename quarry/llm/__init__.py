"""Operators for preparing training data: sharding, scoring, deduplication, packing, archives, classifiers.

Nothing else in the package imports this subpackage.
"""
