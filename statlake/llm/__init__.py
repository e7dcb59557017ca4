"""Operators for preparing training text: scoring, filtering, deduplication,
packing, formatting, tokenising and archiving.  Nothing else in the library
imports this package."""
