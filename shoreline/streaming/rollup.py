"""Live aggregates."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoreline.streaming.ingest import start
from shoreline.streaming.silver import BATCH
from shoreline.streaming.states import StateFolder


def activity(stream: DataFrame, time: str, width: str = "1 minute", delay: str | None = None) -> DataFrame:
    """Rows per time window of a stream.

    Without ``delay`` every window stays open, for complete output; with it, windows close
    behind the watermark and append output is possible.
    """
    if delay:
        stream = stream.withWatermark(time, delay)
    return (stream.groupBy(F.window(time, width).alias("_window")).agg(F.count("*").alias("entries"))
            .select(F.col("_window.start").alias("bucket"), "entries"))


def keep_current(aggregate: DataFrame, path: str, checkpoint: str, drain: bool = True,
                 state_partitions: int | None = None) -> StreamingQuery:
    """Store the complete state of a streaming aggregate after each micro-batch; two states stay.

    Every micro-batch has a folder of its own, so a reader never meets a half-written one
    and a retried batch replaces only itself.
    """
    states = StateFolder(aggregate.sparkSession, path)
    writer = aggregate.writeStream.outputMode("complete").foreachBatch(states.put).option("checkpointLocation", checkpoint)
    return start(aggregate.sparkSession, writer, drain, state_partitions=state_partitions)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The state after the newest micro-batch, found by its name."""
    return StateFolder(spark, path).current()


def keep_live(aggregate: DataFrame, path: str, checkpoint: str, bucket: str, settle_after: str, drain: bool = True,
              state_partitions: int | None = None) -> StreamingQuery:
    """Keep windows current from the ones that changed, and settle those that cannot change any more.

    ``aggregate`` counts windows of a watermarked stream. Each micro-batch brings the windows
    that changed; they take the place of their old versions in the open state. Windows whose
    start lies ``settle_after`` (the window's width plus the watermark's delay) or more before
    the newest window are behind the watermark: they leave the state for a folder of settled
    windows that only grows. So a micro-batch costs the open windows, whatever the age of the stream.
    """
    spark = aggregate.sparkSession
    states = StateFolder(spark, os.path.join(path, "open"))

    def write(batch: DataFrame, batch_id: int) -> None:
        before = states.before(batch_id)
        merged = batch if before is None else batch.unionByName(before.join(batch.select(bucket), bucket, "left_anti"))
        newest = merged.agg(F.max(bucket)).collect()[0][0]
        done = F.col(bucket) <= F.lit(newest) - F.expr(f"INTERVAL {settle_after}") if newest is not None else F.lit(False)
        merged.filter(done).write.mode("overwrite").parquet(os.path.join(path, "settled", f"{BATCH}={batch_id}"))
        states.put(merged.filter(~done), batch_id)

    writer = aggregate.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return start(spark, writer, drain, state_partitions=state_partitions)


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """Settled and open windows."""
    settled = spark.read.parquet(os.path.join(path, "settled")).drop(BATCH)
    return settled.unionByName(StateFolder(spark, os.path.join(path, "open")).current())


def refresh_on_batch(stream: DataFrame, refresh: Callable[[], None], checkpoint: str,
                     drain: bool = True) -> StreamingQuery:
    """Recompute derived tables after each micro-batch that brought rows."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            refresh()

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return start(stream.sparkSession, writer, drain)
