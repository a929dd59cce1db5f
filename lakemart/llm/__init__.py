"""Operators of a training-data pipeline: audits, tokens, filters, dedup, mixing, search."""
