"""Operators for building language-model training data, each by its own method."""
