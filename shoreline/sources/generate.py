"""Seeded tables and defects that do not depend on partitioning.

Values come from a hash of (row key, column name, seed), so a lost task recomputes the
same rows wherever it runs; ``rand(seed)`` would not promise that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_STEPS = 2**52


def uniform(key: Column, salt: str, seed: int) -> Column:
    """Repeatable value in [0, 1) from a key."""
    return F.pmod(F.xxhash64(key, F.lit(salt), F.lit(seed)), F.lit(_STEPS)) / F.lit(float(_STEPS))


@dataclass(frozen=True)
class IntRange:
    """Whole numbers from ``low`` up to, not including, ``high``."""

    low: int
    high: int

    def column(self, u: Column) -> Column:
        return (F.floor(u * (self.high - self.low)) + self.low).cast("int")


@dataclass(frozen=True)
class DoubleRange:
    """Numbers in [low, high), rounded to ``digits``."""

    low: float
    high: float
    digits: int = 1

    def column(self, u: Column) -> Column:
        return F.round(u * (self.high - self.low) + self.low, self.digits)


@dataclass(frozen=True)
class Choice:
    """One of the values, by weight."""

    values: Sequence
    weights: Sequence[float] | None = None

    def column(self, u: Column) -> Column:
        weights = self.weights or [1.0] * len(self.values)
        total, reached, case = sum(weights), 0.0, None
        for value, weight in zip(self.values[:-1], weights[:-1]):
            reached += weight / total
            case = (F.when(u < reached, F.lit(value)) if case is None
                    else case.when(u < reached, F.lit(value)))
        return F.lit(self.values[-1]) if case is None else case.otherwise(F.lit(self.values[-1]))


@dataclass(frozen=True)
class RiskFlag:
    """1 where the weighted share of exceeded thresholds plus noise passes the cut.

    ``terms`` maps a column to (threshold, weight).
    """

    terms: Mapping[str, tuple[float, float]]
    noise: float = 0.15
    cut: float = 0.45

    def column(self, u: Column) -> Column:
        score = sum((F.when(F.col(c) > t, F.lit(w)).otherwise(F.lit(0.0))
                     for c, (t, w) in self.terms.items()), F.lit(0.0))
        return (score + (u * 2 - 1) * self.noise > self.cut).cast("int")


def generate_table(spark: SparkSession, rows: int, spec: Mapping[str, object], seed: int = 42,
                   key: str = "row_id") -> DataFrame:
    """``rows`` rows with one column per entry of ``spec``, in its order."""
    return generate_over(spark.range(rows).withColumnRenamed("id", key), spec, seed, key)


def generate_over(keys: DataFrame, spec: Mapping[str, object], seed: int, key: str) -> DataFrame:
    """As ``generate_table``, for keys that a table already holds."""
    plain = {n: s for n, s in spec.items() if not isinstance(s, RiskFlag)}
    derived = {n: s for n, s in spec.items() if isinstance(s, RiskFlag)}
    df = keys.select("*", *[s.column(uniform(F.col(key), n, seed)).alias(n) for n, s in plain.items()])
    for name, flag in derived.items():
        df = df.withColumn(name, flag.column(uniform(F.col(key), name, seed)))
    return df


@dataclass(frozen=True)
class Defect:
    """Overwrite ``column`` with ``value`` on rows whose key is 0 modulo ``every``."""

    column: str
    value: object
    every: int


def inject_defects(df: DataFrame, key: str, defects: Sequence[Defect],
                   duplicate_when: Column | None = None,
                   duplicate_changes: Mapping[str, Column] | None = None) -> DataFrame:
    """Dirty copy of a table: bad values (first matching defect wins) and repeated rows.

    Repeats are the clean rows where ``duplicate_when`` holds, with the given changes.
    """
    columns = {}
    for name in {d.column for d in defects}:
        kind = df.schema[name].dataType
        case = None
        for d in (d for d in defects if d.column == name):
            hit, bad = F.col(key) % d.every == 0, F.lit(d.value).cast(kind)
            case = F.when(hit, bad) if case is None else case.when(hit, bad)
        columns[name] = case.otherwise(F.col(name))
    dirty = df.withColumns(columns)
    if duplicate_when is None:
        return dirty
    return dirty.unionByName(df.filter(duplicate_when).withColumns(dict(duplicate_changes or {})))
