"""Readers for files, tables, streams and fixed dimensions."""
