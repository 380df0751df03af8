"""Operators of a training-data pipeline: quality, deduplication, decontamination, tokens, archives, privacy.

Nothing else in the library imports this package.
"""
