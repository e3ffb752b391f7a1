"""Readers for files and stored tables."""
