"""Readers, writers and line formats."""
