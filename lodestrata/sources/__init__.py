"""Readers, writers and ingestion flows."""
