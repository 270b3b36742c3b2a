"""Checked queries by family; importing the package fills the registry."""

from queries import (aggregates, functions, joins, learning, ordering, projections, quality, scalars, scores,  # noqa: F401
                     sinks, sources, streams, texts, windows)
from queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
