"""Readers for tables, CSV seeds and JSON lines."""
