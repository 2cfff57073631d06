"""Operators of a training-data pipeline: quality, toxicity, extraction,
tokenising, packing, fingerprints and deduplication.

Nothing else in the library imports this package.
"""
