"""Operators for large text corpora: sharding, packing, quality, extraction, joins, mixing, dedup."""
