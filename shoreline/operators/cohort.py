"""Cohort roll-ups, rates, comparisons and tests. All are partial-then-final aggregates."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions.numbers import count_where, mean, percent, ratio
from shoreline.operators.ranking import top_k_per_group


def cohort_table(df: DataFrame, groups: Mapping[str, Column], averages: Mapping[str, str],
                 count_name: str = "row_count", digits: int | None = 1, scale: int | None = None) -> DataFrame:
    """Count and rounded averages per cohort; ``averages`` maps output name to column."""
    return df.groupBy(*[c.alias(n) for n, c in groups.items()]).agg(
        F.count("*").alias(count_name), *[mean(F.col(c), digits, scale).alias(n) for n, c in averages.items()])


def rate_by(df: DataFrame, groups: Mapping[str, Column], hit: Column, digits: int = 1) -> DataFrame:
    """Rows, hits and hit rate in percent per group."""
    total, hits = F.count("*"), count_where(hit)
    return df.groupBy(*[c.alias(n) for n, c in groups.items()]).agg(
        total.alias("total"), hits.alias("hits"), percent(hits, total, digits).alias("rate_pct"))


def share_of_total(df: DataFrame, groups: Sequence[str], digits: int = 1) -> DataFrame:
    """Rows per group and their share of all rows.

    The total is a scalar subquery over the grouped counts, which reuses their shuffle; a
    window over () would put all groups into one task.
    """
    counts = df.groupBy(*groups).agg(F.count("*").alias("rows"))
    whole = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("share_pct", percent(F.col("rows"), whole, digits))


def describe(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """(column, count, mean, std, min, max) from one pass."""
    def shown(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    stats = df.agg(*[F.struct(
        F.lit(c).alias("column_name"), F.count(c).alias("row_count"),
        shown(F.avg(F.col(c).cast("double"))).alias("mean"),
        shown(F.stddev_samp(F.col(c).cast("double"))).alias("std"),
        F.min(F.col(c).cast("double")).alias("min"),
        F.max(F.col(c).cast("double")).alias("max")).alias(c) for c in columns])
    return stats.select(F.inline(F.array(*[F.col(c) for c in columns])))


def class_balance(df: DataFrame, label: str, digits: int = 1) -> DataFrame:
    """Rows and share per class."""
    return share_of_total(df, [label], digits)


def compare_metrics(df: DataFrame, flag: Column, metrics: Sequence[str], names: tuple[str, str],
                    digits: int = 1) -> DataFrame:
    """(metric, average with the flag, average without, difference in percent), one pass."""
    with_name, without_name = names
    averages = df.agg(
        *[F.avg(F.when(flag, F.col(m).cast("double"))).alias(f"_yes_{m}") for m in metrics],
        *[F.avg(F.when(~flag, F.col(m).cast("double"))).alias(f"_no_{m}") for m in metrics])
    lines = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"_yes_{m}").alias("yes"),
                               F.col(f"_no_{m}").alias("no")) for m in metrics])
    return averages.select(F.inline(lines)).select(
        "metric", F.round("yes", digits).alias(with_name), F.round("no", digits).alias(without_name),
        F.round(ratio(F.col("yes") - F.col("no"), F.col("no")) * 100, digits).alias("pct_diff"))


def contingency(df: DataFrame, row: str, column: str) -> DataFrame:
    """Observed counts of a two-way table; empty cells are left out."""
    return (df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
            .groupBy(row, column).agg(F.count("*").alias("observed")))


def chi_squared(df: DataFrame, row: str, column: str, significance: float = 0.05) -> DataFrame:
    """Chi-squared test of independence, without continuity correction.

    Summed over the cells that occur as ``(observed - expected)^2 / expected``; the empty
    cells' share is what their expected counts add up to, the rest of n. So no grid of all
    pairs is built and nothing large cancels. The table is counted once; row and column
    totals are sums over the counted cells.
    """
    cells = contingency(df, row, column)
    rows = cells.groupBy(row).agg(F.sum("observed").alias("_row_total"))
    columns = cells.groupBy(column).agg(F.sum("observed").alias("_column_total"))
    observed = F.col("observed").cast("double")
    total = cells.agg(F.sum("observed").cast("double")).scalar()
    expected = F.col("_expected")
    joined = cells.join(rows, row).join(columns, column).withColumn(
        "_expected", F.col("_row_total").cast("double") * F.col("_column_total") / total)
    seen = F.count("*") == F.count_distinct(row) * F.count_distinct(column)
    sums = joined.agg(
        (F.sum((observed - expected) * (observed - expected) / expected)
         + F.when(seen, 0.0).otherwise(F.sum(observed) - F.sum(expected))).alias("chi2_statistic"),
        ((F.count_distinct(row) - 1) * (F.count_distinct(column) - 1)).cast("int").alias("degrees_of_freedom"))
    tail = _chi_squared_tail()
    return (sums.withColumn("p_value", tail("chi2_statistic", "degrees_of_freedom"))
            .withColumn("is_significant", F.col("p_value") < F.lit(significance))
            .select("chi2_statistic", "p_value", "degrees_of_freedom", "is_significant"))


def _chi_squared_tail():
    """Upper tail of the chi-squared distribution, a finite sum for whole degrees of freedom."""
    log, exp, erfc, lgamma = math.log, math.exp, math.erfc, math.lgamma

    def tail(x: float, dof: int) -> float | None:
        if x is None or dof is None or dof < 1:
            return None
        half = max(x, 0.0) / 2
        if half == 0:
            return 1.0
        start, total = (0.0, 0.0) if dof % 2 == 0 else (0.5, erfc(half ** 0.5))
        power = start
        while power < dof / 2 - 0.25:
            if power > 0 or dof % 2 == 0:
                total += exp(power * log(half) - half - lgamma(power + 1))
            power += 1
        return min(total, 1.0)

    @F.pandas_udf("double")
    def udf(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for statistic, dof in pairs:
            yield pd.Series([tail(x, d) for x, d in zip(statistic, dof)], dtype="float64")

    return udf


def top_value(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """Most frequent value (per group); equal counts go to the smaller value.

    The rows are counted first, so the pick runs over distinct values only.
    """
    counts = df.groupBy(*group, value).agg(F.count("*").alias("rows"))
    if not group:
        return counts.orderBy(F.desc("rows"), F.asc(value)).limit(1)
    return top_k_per_group(counts, group, [F.desc("rows"), F.asc(value)], 1).drop("rank")


def best_group(df: DataFrame, group: str, score: str) -> DataFrame:
    """Row with the highest score; ties go to the smaller group."""
    return df.orderBy(F.desc(score), F.asc(group)).limit(1)


def distinct_joined(df: DataFrame, group: Sequence[str], value: str, separator: str = ", ") -> DataFrame:
    """Rows, distinct values and the sorted values as one text per group.

    Counting (group, value) pairs first keeps the collected list to distinct values.
    """
    pairs = df.groupBy(*group, value).agg(F.count("*").alias("_rows"))
    return pairs.groupBy(*group).agg(
        F.sum("_rows").alias("rows"), F.count(value).alias("distinct_values"),
        F.array_join(F.array_sort(F.collect_list(F.col(value).cast("string"))), separator).alias("joined"))
