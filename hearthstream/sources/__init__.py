"""Readers, writers and the table folder."""
