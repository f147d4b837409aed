"""Operators of a training-data pipeline: dedup, extraction, search, filtering,
counting, mixing and packing of text corpora.  Nothing else in the library
imports this subpackage."""
