"""Named tables and small inline relations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Batch scan of a table or view."""
    return spark.table(name)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    """Streaming scan of a file-backed table."""
    return spark.readStream.table(name)


def inline_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """Constant relation for configuration-sized dimensions."""
    return spark.createDataFrame(list(rows), schema)


def rows_per_table(tables: dict[str, DataFrame]) -> DataFrame:
    """One (source, rows) line per table; each count reads no columns."""
    lines = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("source"), "rows")
             for name, df in tables.items()]
    result = lines[0]
    for line in lines[1:]:
        result = result.unionByName(line)
    return result
