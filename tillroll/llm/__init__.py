"""Operators over text corpora, as a training-data pipeline needs them."""
