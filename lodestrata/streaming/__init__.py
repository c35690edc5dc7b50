"""Bounded and continuous streaming flows."""
