"""Operators for large text collections that are to become training data."""
