"""Operators for preparing training text: filters, deduplication, mixing and sharding of a document table."""
