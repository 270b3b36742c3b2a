"""Join shapes: defaults, grids, lookups. Broadcast only behind a size check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 10_000
SMALL_BYTES = 64 * 1024 * 1024
LISTED_VALUES = 1_000


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Broadcast hint where the table is small in rows and bytes, else the table as is.

    The check measures at most ``max_rows + 1`` rows and brings one row to the driver.
    Without the hint, the join is a shuffle whose skewed partitions AQE splits, so both
    ways give the same rows.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))
    rows, written = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(size, F.lit(0))).collect()[0]
    return F.broadcast(df) if rows <= max_rows and written <= max_bytes else df


def left_with_defaults(left: DataFrame, right: DataFrame, on: Sequence[str],
                       defaults: Mapping[str, object]) -> DataFrame:
    """Left join that fills the named columns where nothing matched."""
    joined = left.join(right, list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def grid(rows: DataFrame, dimension: DataFrame, column: str, chunk: int = LISTED_VALUES, salts: int = 16) -> DataFrame:
    """Every row beside every distinct value of a dimension, NULL included, without a cross join.

    The dimension is cut into arrays of about ``chunk`` values. Rows are repeated per array
    and meet it in an equi join; each array is there once per salt, so that the rows of one
    array spread over that many partitions. One path serves all sizes.
    """
    values = dimension.select(column).distinct()
    parts = values.count() // chunk + 1
    arrays = (values.groupBy(F.pmod(F.xxhash64(column), F.lit(parts)).cast("int").alias("_chunk"))
              .agg(F.collect_list(F.struct(column)).alias("_values"))
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    kept = [c for c in rows.columns if c != column]
    repeated = rows.select(*kept, F.pmod(F.xxhash64(*kept), F.lit(salts)).cast("int").alias("_salt"),
                           F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_chunk"))
    return repeated.join(arrays, ["_chunk", "_salt"]).select(*kept, F.inline("_values"))


def absent_keys(new: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key does not occur in ``existing``.

    Repeated existing keys are combined per task before they shuffle, so a frequent key
    does not fill one partition.
    """
    return new.join(existing.select(*key).distinct(), list(key), "left_anti")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def require_unique(df: DataFrame, key: Sequence[str], what: str) -> None:
    """Raise if a key repeats; stops at the first repeated key found."""
    repeated = duplicate_keys(df, key).limit(1).collect()
    if repeated:
        raise ValueError(f"{what}: key {list(key)} is not unique, e.g. {repeated[0].asDict()}")


def feature_lookup(rows: DataFrame, features: DataFrame, key: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows with the features stored under their primary key, which must be unique."""
    require_unique(features, key, "feature table")
    return rows.join(features, list(key), how)


def with_scalars(df: DataFrame, *facts: tuple[DataFrame, Mapping[str, Column]]) -> DataFrame:
    """Add one-row aggregates of other tables as columns.

    Each pair of table and named aggregates becomes one scalar subquery, so a table is
    read once however many aggregates are asked of it.
    """
    for i, (table, aggregates) in enumerate(facts):
        row = table.agg(F.struct(*[a.alias(n) for n, a in aggregates.items()])).scalar()
        df = df.withColumn(f"_fact_{i}", row).select("*", f"_fact_{i}.*").drop(f"_fact_{i}")
    return df
