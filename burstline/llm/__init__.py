"""Operators over documents for building training corpora."""
