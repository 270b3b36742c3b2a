"""Streaming deduplication.

``arrival_dedup`` is the plain form: state grows with the number of keys and the first
arrival wins. ``bounded_dedup`` forgets keys behind the watermark. ``log_earliest`` needs no
state: each micro-batch appends its own winners, and ``read_earliest`` picks the earliest
over all batches, so the result equals the batch operator for any arrival order.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shoreline.operators.dedup import keep_earliest
from shoreline.operators.quality import Rule, apply_rules
from shoreline.streaming.ingest import start

BATCH = "micro_batch"
#: Sub-folder of compacted parts of a log; hidden from readers of the log's own folder.
COMPACTED = "_compacted"


def arrival_dedup(stream: DataFrame, key: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """First arrival per key, then the rules."""
    return apply_rules(stream.dropDuplicates(list(key)), rules)


def bounded_dedup(stream: DataFrame, key: Sequence[str], time: str, delay: str, rules: Sequence[Rule]) -> DataFrame:
    """First arrival per key within ``delay``; exact while repeats come no later than that."""
    seen = stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))
    return apply_rules(seen, rules)


def log_earliest(stream: DataFrame, path: str, checkpoint: str, key: Sequence[str], time: str,
                 tie_break: Sequence[str] = (), drain: bool = True) -> StreamingQuery:
    """Append each micro-batch's earliest row per key to a log of candidates.

    A micro-batch costs its own size, never the size of the table. Its folder is
    overwritten when the batch is retried, so every batch counts once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        winners = keep_earliest(batch, key, time, tie_break)
        winners.write.mode("overwrite").parquet(os.path.join(path, f"{BATCH}={batch_id}"))

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return start(stream.sparkSession, writer, drain)


def read_earliest(spark: SparkSession, path: str, key: Sequence[str], time: str, rules: Sequence[Rule],
                  tie_break: Sequence[str] = ()) -> DataFrame:
    """Clean table from the candidate log: earliest per key first, rules after."""
    return apply_rules(keep_earliest(candidates(spark, path), key, time, tie_break), rules)


def _children(spark: SparkSession, path: str, name: str) -> dict[int, str]:
    """Whole folders ``name=<number>`` below a path, by number."""
    def place(at: str):
        return spark._jvm.org.apache.hadoop.fs.Path(at)
    folder = place(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for status in system.listStatus(folder) if system.exists(folder) else []:
        match = re.fullmatch(rf"{name}=(\d+)", status.getPath().getName())
        if match and system.exists(place(os.path.join(path, match[0], "_SUCCESS"))):
            found[int(match[1])] = os.path.join(path, match[0])
    return found


def live_folders(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """What makes up the log: the newest compacted folder and the micro-batches after it.

    A compacted folder names the last micro-batch it covers and is whole once its write has
    succeeded; that one step switches readers over, and later micro-batches add to it.
    """
    compacted = _children(spark, os.path.join(path, COMPACTED), COMPACTED.strip("_"))
    upto = max(compacted, default=-1)
    batches = {n: p for n, p in _children(spark, path, BATCH).items() if n > upto}
    return max([upto, *batches]), ([compacted[upto]] if compacted else []) + [batches[n] for n in sorted(batches)]


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the live folders of a candidate log."""
    folders = live_folders(spark, path)[1]
    if not folders:
        raise ValueError(f"no whole micro-batch in {path}")
    return spark.read.parquet(*folders)


def compact_log(spark: SparkSession, path: str, key: Sequence[str], time: str, tie_break: Sequence[str] = ()) -> int:
    """Replace the live folders of a candidate log by one with one row per key, while the stream goes on.

    Returns the last micro-batch that is covered. A compaction that dies leaves the log as it
    was; the next one writes the same folder anew. Folders that the compaction before this one
    had already replaced are removed, so readers that began before this one still find theirs.
    """
    upto, folders = live_folders(spark, path)
    covered = max(_children(spark, os.path.join(path, COMPACTED), COMPACTED.strip("_")), default=-1)
    if upto > covered:
        keep_earliest(spark.read.parquet(*folders), key, time, tie_break).write.mode("overwrite").parquet(
            os.path.join(path, COMPACTED, f"{COMPACTED.strip('_')}={upto}"))
        old = [p for n, p in _children(spark, path, BATCH).items() if n <= covered]
        old += [p for n, p in _children(spark, os.path.join(path, COMPACTED), COMPACTED.strip("_")).items() if n < covered]
        for folder in old:
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return upto
