"""Operators of a training-data pipeline: sampling, deduplication, filtering, packing, sharding, archives."""
