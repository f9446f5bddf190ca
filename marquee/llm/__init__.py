"""Operators of a training-data pipeline: identification, cleaning, deduplication, packing and sharding of texts."""
