"""Operators for building training data: search, mixing, tokenising, labelling, deduplication, sharding."""
