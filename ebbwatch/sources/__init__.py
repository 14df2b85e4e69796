"""Readers, writers and the adapter that builds the raw customer table."""
