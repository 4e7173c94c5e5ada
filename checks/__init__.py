"""Queries registered for verification, their inputs and their SQL."""
