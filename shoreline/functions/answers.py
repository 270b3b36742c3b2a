"""Three-valued answer check as one expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoreline.functions.text import normalize, numeric_tokens, starts_with_any

# Prefixes that mark an answer as failed.
FAILED_PREFIXES = ("error", "failed")


def answer_verdict(answer: Column, expected: Column, tolerance: float = 0.5,
                   strict: bool = False) -> Column:
    """True, false, or NULL for "cannot tell", from the two raw texts."""
    given, wanted = normalize(answer), normalize(expected)
    return verdict(given, numeric_tokens(given), wanted, numeric_tokens(wanted), tolerance, strict)


def verdict(given: Column, given_numbers: Column, wanted: Column, wanted_numbers: Column,
            tolerance: float = 0.5, strict: bool = False) -> Column:
    """True, false, or NULL for "cannot tell", from normalised texts and their numbers.

    Empty and failed answers are false and equal texts true. Where both sides hold
    numbers, any pair within the tolerance decides; ``strict`` asks instead that every
    expected number be met. Without numbers, either text holding the other is true.
    """
    def near(x: Column) -> Column:
        return F.exists(given_numbers, lambda y: F.abs(x - y) <= F.lit(tolerance))

    met = F.forall(wanted_numbers, near) if strict else F.exists(wanted_numbers, near)
    return (
        F.when((given == "") | starts_with_any(given, FAILED_PREFIXES), F.lit(False))
        .when(given == wanted, F.lit(True))
        .when((F.size(given_numbers) > 0) & (F.size(wanted_numbers) > 0), met)
        .when(given.contains(wanted) | wanted.contains(given), F.lit(True))
    )
