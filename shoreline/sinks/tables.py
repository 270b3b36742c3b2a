"""Catalog tables on parquet."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoreline.operators.joins import absent_keys
from shoreline.session import shared_folder


def overwrite_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a table; the schema may change."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def create_table_as(spark: SparkSession, table: str, query: str, path: str | None = None) -> None:
    """Store the result of a SQL query as a new or replaced table."""
    overwrite_table(spark.sql(query), table, path)


def create_table_if_absent(spark: SparkSession, table: str, columns: Mapping[str, str],
                           path: str | None = None) -> None:
    """Typed empty table; a second call changes nothing."""
    listed = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({listed}) USING parquet{place}")


def append_rows(df: DataFrame, table: str) -> None:
    """Append a batch of rows in one job, matched by column name."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.mode("append").insertInto(table)


def register_missing(new: DataFrame, table: str, key: Sequence[str]) -> None:
    """Insert the rows whose key the table does not hold yet; repeated new keys go in once."""
    fresh = absent_keys(new.dropDuplicates(list(key)), new.sparkSession.table(table), key)
    append_rows(fresh, table)


def insert_overwrite(df: DataFrame, table: str) -> None:
    """Replace the content of a table and keep the table.

    The rows are written once, to a new folder beside the table's, and the table is then
    pointed there in one step: they may come from the table itself, and whatever fails before
    leaves the old content. The old folder goes last. Partitioned and bucketed tables, whose
    files the catalog knows one by one, are rewritten in place from a staging copy.
    """
    spark = df.sparkSession
    schema = spark.table(table).schema
    rows = df.select([F.col(f"`{f.name}`").cast(f.dataType) for f in schema])
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    old = detail["Location"]
    if {"# Partition Information", "Num Buckets"} & set(detail):
        staging = shared_folder(spark, "staging")
        rows.write.parquet(staging)
        spark.read.schema(schema).parquet(staging).write.insertInto(table, overwrite=True)
        remove_folder(spark, staging)
        return
    new = f"{old.rstrip('/')}-{uuid.uuid4().hex[:12]}"
    rows.write.parquet(new)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    spark.catalog.refreshTable(table)
    remove_folder(spark, old)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store its path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row per file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def refresh_materialized(name: str, compute: Callable[[SparkSession], DataFrame], spark: SparkSession,
                         path: str | None = None) -> DataFrame:
    """Recompute a derived table from its sources and store it."""
    overwrite_table(compute(spark), name, path)
    return spark.table(name)


def define_view(df: DataFrame, name: str) -> None:
    """Named view; computed when read."""
    df.createOrReplaceTempView(name)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> None:
    """Lay a table out by the columns, so that file min/max ranges are narrow and scans skip files.

    Range partitioning samples the data; a value with many rows may fill one file, but
    ordering by all given columns lets the next column split it.
    """
    spread = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    spread.sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def z_order(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """A number whose order keeps rows together that are near in all of the columns.

    Every column is cut into 2^bits ranges of about equal rows, by approximate percentiles of
    one pass over the table, and the bits of the range numbers are interleaved. NULL is the
    lowest range. Text is ranked by its first six bytes.
    """
    ranks = [2**-bits * i for i in range(1, 2**bits)]
    numbers = [_number(c, df.schema[c].dataType) for c in columns]
    cuts = df.agg(*[F.percentile_approx(n, ranks, 10_000) for n in numbers]).collect()[0]
    total = F.lit(0).cast("long")
    for i, (number, cut) in enumerate(zip(numbers, cuts)):
        total = total + _spread_range(number, [float(c) for c in cut or [0.0]], [bit * len(columns) + i for bit in range(bits)])
    return total


def _spread_range(number: Column, cuts: Sequence[float], at: Sequence[int]) -> Column:
    """How many of the rising cuts a number reaches, its bits moved to the given places.

    Found by halving, in compiled comparisons; the moved bits are constants. NULL reaches none.
    """
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(sum((low >> bit & 1) << place for bit, place in enumerate(at))).cast("long")
        middle = (low + high) // 2
        return F.when(F.lit(cuts[middle]) <= number, between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(cuts))


def _number(column: str, kind: T.DataType) -> Column:
    """A double in the order of the column."""
    c = F.col(f"`{column}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    return (c.cast("timestamp") if isinstance(kind, T.TimestampNTZType) else c).cast("double")


def write_zordered(df: DataFrame, path: str, columns: Sequence[str], file_bytes: int = 128 << 20, files: int | None = None,
                   packing: float = 4.0) -> None:
    """Lay a table out by several columns at once, so that a filter on any of them skips files.

    Files are cut by bytes: their number follows from the rows' mean size as text, which
    parquet packs about ``packing`` times, unless ``files`` gives it.
    """
    if files is None:
        rows, size = df.agg(F.count("*"), F.avg(F.octet_length(F.to_json(F.struct("*"))))).collect()[0]
        files = max(1, math.ceil(rows * (size or 0) / packing / file_bytes))
    placed = df.withColumn("_z", z_order(df, columns))
    placed.repartitionByRange(files, "_z").sortWithinPartitions("_z", *columns).drop("_z").write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: Sequence[str], path: str | None = None) -> None:
    """Bucketed and sorted by key, so later joins on the key need no shuffle."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *key).sortBy(*key)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
