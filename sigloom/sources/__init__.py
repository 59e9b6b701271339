"""Logical tables, readers and writers."""
