"""What the operators of this folder share: safe columns, table scans, fresh shared folders."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.session import checkpoint_root, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name, with its DuckDB text where SQL can say it."""
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The table written once to the shared folder and read back.

    Later steps then neither repeat the work nor depend on executors that may be lost.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Point the context at the session's shared folder before the first ``checkpoint()``."""
    checkpoint_root(spark)


class Workspace:
    """The intermediate tables of one job, each in a folder of its own below the shared folder.

    A table that later steps have been stored without is dropped with ``drop``, so a job holds
    only what it still reads. Nothing that a dropped table fed may be computed again, so drop
    a table only when what was made from it is stored.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.root = spark, shared_folder(spark, purpose)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """The table written once and read back."""
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove_folder(self.spark, f"{self.root}/{name}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store its path names; a folder that is not there is passed over."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def bitmap_of(bits: DataFrame, size: int) -> np.ndarray:
    """The column ``bit`` (0 to 2^size - 1) as one bitmap of 2^size bits, the lowest bit of a byte first.

    Set bits are combined in every task; the driver gets at most 2^(size - 15) pieces of 4 KB.
    """
    bitmap = np.zeros(1 << (size - 3), np.uint8)
    pieces = bits.groupBy(F.shiftright("bit", 15).alias("piece")).agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(32767)).alias("bits"))
    for row in pieces.collect():
        bitmap[row["piece"] * 4096:(row["piece"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return bitmap


def in_bitmap(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the bits are set."""
    return (bitmap[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 == 1
