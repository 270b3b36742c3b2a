"""Buckets, code labels, flags and point tiers as CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucketize(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Half-open buckets ``value < edge``; the last label takes the rest, NULL included."""
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must be one longer than edges")
    if list(edges) != sorted(edges):
        raise ValueError("edges must ascend")
    if not edges:
        return F.lit(labels[0])
    case = F.when(value < F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:]):
        case = case.when(value < F.lit(edge), F.lit(label))
    return case.otherwise(F.lit(labels[-1]))


def code_label(code: Column, mapping: Mapping, default: str | None = None) -> Column:
    """Label of a code; a code outside the mapping gives ``default`` (NULL unless given)."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    label = F.try_element_at(pairs, code)
    return label if default is None else F.coalesce(label, F.lit(default))


def flag_label(test: Column, yes: str, no: str) -> Column:
    """``yes`` where the test holds, ``no`` elsewhere (a NULL test counts as not holding)."""
    return F.when(test, F.lit(yes)).otherwise(F.lit(no))


def tier_points(value: Column, tiers: Sequence[tuple[float, float]], otherwise: float | Column = 0,
                strict: bool = False) -> Column:
    """Points of the highest tier reached; ``tiers`` holds (threshold, points) pairs.

    A tier is reached at its threshold, or only above it when ``strict`` is set.
    """
    case = None
    for threshold, points in sorted(tiers, reverse=True):
        reached = value > F.lit(threshold) if strict else value >= F.lit(threshold)
        case = F.when(reached, F.lit(points)) if case is None else case.when(reached, F.lit(points))
    rest = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return rest if case is None else case.otherwise(rest)
