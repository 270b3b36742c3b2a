"""Whole jobs put together from sources, operators and sinks."""
