"""Operators that prepare training data: sharding, search, cleaning, deduplication, scoring."""
