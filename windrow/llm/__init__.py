"""Operators for large-scale training-data work: encoding, deduplication, filters, mixing."""
