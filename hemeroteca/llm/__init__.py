"""Operators that prepare training data: encoding, packing, filtering, deduplication, classification."""
