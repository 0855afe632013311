"""Readers, writers and the table contract."""
