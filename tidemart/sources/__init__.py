"""Readers for landed files and stored tables."""
