"""Scalar column helpers."""
