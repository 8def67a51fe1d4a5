"""Operators for preparing training data: sharding, filtering, near-dedup, packing, output."""
