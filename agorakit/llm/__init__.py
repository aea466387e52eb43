"""Operators for large text corpora that become training data. Nothing else in the library imports this folder."""
