"""Operators of a training-data pipeline: mixing, near and exact
deduplication, archives, URL filters, token output and quality scores.
Nothing outside this package imports it."""
