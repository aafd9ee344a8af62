"""Operators of a training-data pipeline: tokenisation and packing, quality and
toxicity scoring, near-duplicate joins, embedding search, web archives and
source mixing. Nothing else in the library imports this subpackage."""
