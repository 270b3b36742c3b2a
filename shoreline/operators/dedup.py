"""Keyed and whole-row deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from pyspark.sql import functions as F

from shoreline.operators.ranking import top_k_per_group


def keep_earliest(df: DataFrame, key: Sequence[str], time: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per key, the earliest; ``tie_break`` decides between equal times.

    Spark keeps one row per key and task before the shuffle (a partial window group
    limit), so a key that holds a third of all rows sends one row per task, not all.
    """
    return _first(df, key, [F.col(time).asc(), *[F.col(c).asc() for c in tie_break]])


def keep_latest(df: DataFrame, key: Sequence[str], time: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per key, the latest."""
    return _first(df, key, [F.col(time).desc(), *[F.col(c).desc() for c in tie_break]])


def _first(df: DataFrame, key: Sequence[str], order: list[Column]) -> DataFrame:
    return top_k_per_group(df, key, order, 1, name="_rn").drop("_rn")


def distinct_complete_rows(df: DataFrame) -> DataFrame:
    """Drop repeated rows, then rows with any NULL.

    Rows with a NULL are filtered first: the result is the same and fewer rows shuffle.
    """
    return df.na.drop().dropDuplicates()
