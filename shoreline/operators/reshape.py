"""Projection helpers: existing columns, renames, long form, schema alignment, flattening."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions.text import row_sentence


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename old to new; names that do not occur are left alone."""
    return df.withColumnsRenamed(dict(names))


def stamped(df: DataFrame, name: str = "ingested_at", **constants: object) -> DataFrame:
    """Load timestamp plus literal columns."""
    return df.withColumn(name, F.current_timestamp()).withColumns(
        {c: F.lit(v) for c, v in constants.items()})


def align_schema(df: DataFrame, target: Mapping[str, str], renames: Mapping[str, str] | None = None,
                 defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Fit a changed source to a target schema (column name to type).

    Renamed columns get their old names back, columns the source lost come back as typed
    NULL or the given default, and columns outside the target are dropped.
    """
    df = df.withColumnsRenamed(dict(renames or {}))
    defaults = dict(defaults or {})
    return df.select(*[
        (F.col(c) if c in df.columns else F.lit(defaults.get(c))).cast(kind).alias(c)
        for c, kind in target.items()])


def wide_to_long(df: DataFrame, ids: Sequence[str], components: Sequence[str], name: str = "category",
                 value: str = "points") -> DataFrame:
    """One row per component column."""
    return df.unpivot(list(ids), list(components), name, value)


def flatten_result(df: DataFrame, columns: Sequence[str], order: Sequence[Column | str],
                   name: str = "answer", rows: int = 5) -> DataFrame:
    """A small result as one text: ``a, b; c, d`` for the first rows, a lone cell bare."""
    first = df.orderBy(*order).limit(rows)
    numbered = first.select(F.monotonically_increasing_id().alias("_at"),
                            row_sentence(*[F.col(c) for c in columns]).alias("_line"))
    lines = F.array_sort(F.collect_list(F.struct("_at", "_line")))
    return numbered.agg(F.array_join(F.transform(lines, lambda x: x["_line"]), "; ").alias(name))
