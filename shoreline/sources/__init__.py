"""Scans: files, named tables, inline rows, generated tables."""
