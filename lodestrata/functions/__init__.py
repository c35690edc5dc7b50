"""Scalar and SQL functions."""
