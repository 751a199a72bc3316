"""Operators for preparing training data: sharding, filtering, deduplication, packing."""
