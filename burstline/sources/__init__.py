"""Readers, writers and stored layouts."""
