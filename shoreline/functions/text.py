"""Text tests, normalising and assembling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token that reads as a number, after lower-casing.
NUMBER_TOKEN = (r"^[+-]?(([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+)?"
                r"|inf|infinity|nan)$")


def normalize(text: Column) -> Column:
    """Trim, lower-case, drop ``%`` and ``,``, turn ``;`` into a blank; NULL becomes empty."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")
    return F.translate(F.lower(trimmed), ";%,", " ")


def numeric_tokens(text: Column) -> Column:
    """Blank-separated tokens of a normalised text that read as numbers, as array<double>.

    Infinities and NaN are numbers too; they lie within no tolerance of anything.
    """
    kept = F.filter(F.split(text, r"\s+"), lambda t: t.rlike(NUMBER_TOKEN))
    return F.transform(kept, lambda t: F.translate(t, "_", "").cast("double"))


def contains_any(text: Column, words: Sequence[str], whole_words: bool = False) -> Column:
    """True where the lower-cased text holds one of the words.

    The default is a substring test ("age" is found in "average"); ``whole_words`` asks
    for word boundaries. Plain ``contains`` keeps the test free of regex machinery.
    """
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [_hit(lowered, w, whole_words) for w in words])


def count_hits(text: Column, words: Sequence[str], whole_words: bool = False) -> Column:
    """How many of the words the lower-cased text holds."""
    lowered = F.lower(text)
    return reduce(lambda a, b: a + b,
                  [F.coalesce(_hit(lowered, w, whole_words), F.lit(False)).cast("int") for w in words])


def _hit(lowered: Column, word: str, whole_words: bool) -> Column:
    if whole_words:
        return lowered.rlike(r"(?<!\p{L})" + r"\Q" + word.lower() + r"\E" + r"(?!\p{L})")
    return lowered.contains(word.lower())


def starts_with_any(text: Column, prefixes: Sequence[str]) -> Column:
    """True where the text starts with one of the prefixes."""
    return reduce(lambda a, b: a | b, [text.startswith(p) for p in prefixes])


def has_digit(text: Column) -> Column:
    """True where any decimal digit occurs."""
    return text.rlike("[0-9]")


def truncated(text: Column, length: int) -> Column:
    """The first ``length`` characters, for previews."""
    return F.left(text, F.lit(length))


def assemble(*parts: Column | str) -> Column:
    """Concatenate texts and columns with an implicit cast; one NULL part gives NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def assemble_or_blank(*parts: Column | str) -> Column:
    """As ``assemble``, with NULL parts left out."""
    return F.concat(*[F.lit(p) if isinstance(p, str)
                      else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def row_sentence(*values: Column) -> Column:
    """One row as ``a, b, c``; NULL values are skipped."""
    return F.concat_ws(", ", *[v.cast("string") for v in values])
