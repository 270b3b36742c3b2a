"""Streams from landing folders and tables into append-only tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

PARTITIONS = "spark.sql.shuffle.partitions"


def stream_files(spark: SparkSession, path: str, schema: T.StructType | str, format: str = "json",
                 files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder and its sub-folders as a stream; the query's checkpoint makes each count once."""
    reader = spark.readStream.schema(schema).format(format).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def land(stream: DataFrame, path: str, checkpoint: str, drain: bool = True,
         state_partitions: int | None = None) -> StreamingQuery:
    """Append a stream to a parquet folder.

    ``drain`` works off what is there and stops; a later call with the same checkpoint
    picks up only what is new. A stream with state keeps the number of state partitions
    of its first start for the life of its checkpoint, so set ``state_partitions`` for the
    size the state will reach.
    """
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    return start(stream.sparkSession, writer, drain, path, state_partitions)


def start(spark: SparkSession, writer: DataStreamWriter, drain: bool, path: str | None = None,
          state_partitions: int | None = None) -> StreamingQuery:
    """Start a query; with ``drain``, wait until all present input is done."""
    if drain:
        writer = writer.trigger(availableNow=True)
    before = spark.conf.get(PARTITIONS)
    if state_partitions:
        spark.conf.set(PARTITIONS, str(state_partitions))
    try:
        query = writer.start(path) if path else writer.start()
    finally:
        spark.conf.set(PARTITIONS, before)
    if drain:
        query.awaitTermination()
    return query
