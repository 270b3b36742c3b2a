"""Ranks, top-k and samples that never put a whole table or group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoreline.session import checkpoint_root

_POSITION_BITS = 33


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """``row_number()`` over the whole table without a one-partition window.

    The rows are sorted by range partitioning, each is marked with its partition and
    position, and the marked table is checkpointed: the marks then stay fixed when a lost
    executor's tasks rerun. The rank is the position plus the rows of the partitions
    before, a table of one row per partition. ``order`` should end with a unique key, which
    also lets range partitioning split a value that many rows share.
    """
    checkpoint_root(df.sparkSession)
    marked = df.orderBy(*order).withColumn("_mark", F.monotonically_increasing_id()).checkpoint()
    marked = marked.withColumn("_part", F.shiftright("_mark", _POSITION_BITS))
    sizes = marked.groupBy("_part").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    position = F.col("_mark") - F.shiftleft("_part", _POSITION_BITS)
    return (marked.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + position + 1)
            .drop("_mark", "_part", "_before"))


def rank_in_hash_order(df: DataFrame, group: Sequence[str], key: Sequence[str], seed: int,
                       buckets: int = 65_536) -> DataFrame:
    """Adds ``_rank`` and ``_size``: a seeded random order inside each group.

    A group as large as a third of the table is spread over ``buckets`` hash ranges.
    Rows are numbered inside their (group, bucket) and lifted by the count of the group's
    earlier buckets, so no task sees more than a bucket. ``key`` must be unique.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*key, F.lit(seed)))
    hashed = hashed.withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
    counts = hashed.groupBy(*group, "_bucket").agg(F.count("*").alias("_count"))
    ordered = Window.partitionBy(*group).orderBy("_bucket")
    earlier = F.sum("_count").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(
        *[F.col(g).alias(f"_of_{g}") for g in group], F.col("_bucket").alias("_of_bucket"),
        F.coalesce(earlier, F.lit(0)).alias("_before"),
        F.sum("_count").over(Window.partitionBy(*group)).alias("_size"))
    inside = Window.partitionBy(*group, "_bucket").orderBy("_hash", *key)
    numbered = hashed.withColumn("_inside", F.row_number().over(inside))
    same = F.col("_bucket") == F.col("_of_bucket")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return (numbered.join(offsets, same)
            .withColumn("_rank", F.col("_before") + F.col("_inside"))
            .drop("_hash", "_bucket", "_inside", "_before", "_of_bucket", *[f"_of_{g}" for g in group]))


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """First k rows in order: each task keeps k, the driver merges k per task."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    name: str = "rank") -> DataFrame:
    """First k rows of each group; the rank filter is pushed below the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)


def fixed_size_sample(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement; the same rows on any partitioning."""
    return df.orderBy(F.xxhash64(*key, F.lit(seed)), *key).limit(n)


def gap_to_leader(df: DataFrame, points: str, name: str = "gap_to_leader") -> DataFrame:
    """Distance to the best row, by a scalar subquery instead of a global window."""
    leader = df.agg(F.max(points)).scalar()
    return df.withColumn(name, F.col(points) - leader)


def medal(rank: Column) -> Column:
    """Label of the first three ranks."""
    return F.when(rank == 1, "gold").when(rank == 2, "silver").when(rank == 3, "bronze")


def change_from_previous(df: DataFrame, group: Sequence[str], period: str, value: str) -> DataFrame:
    """Previous period's value inside the group and the difference to it.

    The input holds one row per group and period, as an aggregate gives it, so a group is
    as long as there are periods.
    """
    window = Window.partitionBy(*group).orderBy(period)
    previous = F.lag(value).over(window)
    return df.withColumn("previous", previous).withColumn("change", F.col(value) - F.col("previous"))


def dense_rank_within(df: DataFrame, period: Sequence[str], value: str, name: str = "rank") -> DataFrame:
    """Dense rank by falling value inside each period, over rows already aggregated per period."""
    window = Window.partitionBy(*period).orderBy(F.col(value).desc())
    return df.withColumn(name, F.dense_rank().over(window))
