"""Derived columns for models, kept in a table with a unique key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.operators.joins import require_unique
from shoreline.sinks.tables import overwrite_table

# The model's input columns in the clinical table.
CLINICAL_COLUMNS = ["age", "sex", "cp", "trestbps", "chol", "fbs", "restecg", "thalach", "exang",
                    "oldpeak", "slope", "ca", "thal"]


def reserve(age: Column, rate: Column, top: float = 220) -> Column:
    """Heart-rate reserve: the age-based maximum less the reached rate."""
    return F.lit(top) - age - rate


def both_over(a: Column, a_limit: float, b: Column, b_limit: float) -> Column:
    """1 where both exceed their limits, else 0."""
    return F.coalesce((a > a_limit) & (b > b_limit), F.lit(False)).cast("int")


def over(a: Column, limit: float) -> Column:
    """1 above the limit, else 0."""
    return F.coalesce(a > limit, F.lit(False)).cast("int")


def per_plus_one(a: Column, b: Column) -> Column:
    """a / (b + 1) as double, NULL where b is -1."""
    return F.try_divide(a.cast("double"), b + 1)


def clinical_features(df: DataFrame) -> DataFrame:
    """The five derived clinical features."""
    age, chol, bp, rate = (F.col(c) for c in ("age", "chol", "trestbps", "thalach"))
    return df.withColumns({
        "hr_reserve": reserve(age, rate), "high_risk": both_over(age, 55, chol, 240),
        "chol_risk": over(chol, 240), "age_chol": age * chol, "bp_hr_ratio": per_plus_one(bp, rate)})


def fill_missing(df: DataFrame, columns: Sequence[str], value: float = 0) -> DataFrame:
    """NULL to a number in the given columns."""
    return df.na.fill(value, list(columns))


def feature_table(df: DataFrame, key: str, derived: Mapping[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """Key, kept and derived columns."""
    return df.select(key, *keep, *[c.alias(n) for n, c in derived.items()])


def store_features(df: DataFrame, table: str, key: Sequence[str], path: str | None = None) -> None:
    """Write a feature table after checking that its key is unique."""
    require_unique(df, key, f"feature table {table}")
    overwrite_table(df, table, path)
