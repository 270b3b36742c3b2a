"""Rates and ratios with one fixed type, so a schema does not depend on literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, NULL where the whole is zero or NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int | None = 1) -> Column:
    """``part`` in percent of ``whole`` as double."""
    value = ratio(part.cast("double") * F.lit(100.0), whole)
    return value if digits is None else F.round(value, digits)


def count_where(test: Column) -> Column:
    """Number of rows where the test is true; NULL does not count."""
    return F.count(F.when(test, F.lit(1)))


def mean(value: Column, digits: int | None = 1, scale: int | None = None) -> Column:
    """Average as double, rounded unless ``digits`` is None.

    With ``scale``, values are summed as whole units of ``10**-scale``: for measures kept
    to that many decimals the result is the same for any order of rows, so a rerun on
    another partitioning cannot round differently.
    """
    if scale is None:
        average = F.avg(value.cast("double"))
    else:
        units = F.sum(F.round(value * F.lit(10.0**scale)).cast("long")).cast("double")
        average = F.try_divide(units / F.lit(10.0**scale), F.count(value))
    return average if digits is None else F.round(average, digits)
