"""Operators of a training-data pipeline: deduplication, filters, scoring, sharding and packing of documents.

Nothing else in the library imports this package.
"""
