"""Operators for training-data pipelines on the document tables."""
