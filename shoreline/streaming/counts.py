"""Rule counts of a stream, taken while its rows pass."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from shoreline.functions.numbers import count_where
from shoreline.operators.quality import Rule
from shoreline.session import read_json_log

COUNTS_SCHEMA = "micro_batch long, rule string, action string, passed long, failed long"


class RuleCounts(StreamingQueryListener):
    """Writes (micro_batch, rule, action, passed, failed) of an observed stream to a folder.

    The counts come with the progress of each micro-batch, so the rows are read once. A
    micro-batch's file is named by it and replaced when the batch is retried, so it counts once.
    """

    def __init__(self, spark: SparkSession, name: str, rules: Sequence[Rule], path: str):
        self.spark, self.name, self.rules, self.path = spark, name, list(rules), path
        self.seen: set[tuple[str, int]] = set()

    def observed(self, stream: DataFrame) -> DataFrame:
        """The same stream, with its rules counted; nothing is dropped here."""
        return stream.observe(self.name, F.count(F.lit(1)).alias("rows"),
                              *[count_where(r.holds()).alias(f"rule_{i}") for i, r in enumerate(self.rules)])

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(self.name)
        if counts is not None:
            found = counts.asDict()
            if found["rows"]:
                self._store(progress.batchId, found)
            self.seen.add((str(progress.runId), progress.batchId))

    def _store(self, batch_id: int, found: dict) -> None:
        lines = [{"micro_batch": batch_id, "rule": r.name, "action": r.action, "passed": found[f"rule_{i}"], "failed": found["rows"] - found[f"rule_{i}"]}
                 for i, r in enumerate(self.rules)]
        file = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, f"batch-{batch_id:010d}.json"))
        out = file.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(file, True)
        out.write(bytearray("".join(json.dumps(x) + "\n" for x in lines).encode()))
        out.close()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until the counts of all micro-batches of a drained query have come in."""
        wanted = {(p["runId"], p["batchId"]) for p in query.recentProgress if self.name in (p.get("observedMetrics") or {})}
        end = time.monotonic() + seconds
        while not wanted <= self.seen:
            if time.monotonic() > end:
                raise TimeoutError(f"counts of micro-batches {sorted(b for _, b in wanted - self.seen)} did not come")
            time.sleep(0.05)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts per micro-batch and rule."""
    return read_json_log(spark, path, COUNTS_SCHEMA)


def total_counts(counts: DataFrame) -> DataFrame:
    """Counts per rule over all micro-batches, as the batch report has them."""
    return counts.groupBy("rule", "action").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
