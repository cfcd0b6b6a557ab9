"""Operators of a training-data pipeline: dedup, tokenising, packing, search, classifiers, rules, sharding, extraction."""
