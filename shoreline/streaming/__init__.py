"""Structured Streaming forms of the landing, cleaning and roll-up steps."""
