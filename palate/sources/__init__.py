"""Readers, writers and the mapping of generic sales tables onto rating tables."""
