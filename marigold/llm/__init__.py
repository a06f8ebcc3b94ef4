"""Operators for building training data out of raw documents."""
