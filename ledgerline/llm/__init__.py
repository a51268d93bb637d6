"""Operators for text corpora at the scale of training data, and their queries."""
