"""Operators of a training-data pipeline: cleaning, deduplication, tokenising and packing of texts.

Nothing else in the library imports this package; `catalog` lists its queries.
"""
