"""Readers and parsers: tables, delimited lines, task rows, streams."""
