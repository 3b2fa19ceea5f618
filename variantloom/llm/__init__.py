"""Operators for building training data from text tables."""
