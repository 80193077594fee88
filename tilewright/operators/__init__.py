"""Decoding, classification, aggregation and comparison of tiles."""
