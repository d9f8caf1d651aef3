"""Readers, writers and schema contracts."""
