"""Seeded stratified splits that give the same rows on any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.operators.ranking import rank_in_hash_order


def mark_split(df: DataFrame, label: str, key: Sequence[str], train: float = 0.8, seed: int = 42,
               name: str = "is_train") -> DataFrame:
    """Mark ``ceil(train * n)`` rows of every class as training rows."""
    ranked = rank_in_hash_order(df, [label], key, seed)
    return ranked.withColumn(name, F.col("_rank") <= F.ceil(F.col("_size") * F.lit(train))).drop("_rank", "_size")


def stratified_split(df: DataFrame, label: str, key: Sequence[str], train: float = 0.8,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with the same class shares."""
    marked = mark_split(df, label, key, train, seed)
    return (marked.filter("is_train").drop("is_train"), marked.filter("NOT is_train").drop("is_train"))


def stratified_folds(df: DataFrame, label: str, key: Sequence[str], folds: int = 5, seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """Fold number 0 to folds - 1; each class is spread evenly."""
    ranked = rank_in_hash_order(df, [label], key, seed)
    return ranked.withColumn(name, F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_rank", "_size")
