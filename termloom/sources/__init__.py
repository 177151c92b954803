"""Readers and converters of source files."""
