"""Operators on items, clusters and digests."""
