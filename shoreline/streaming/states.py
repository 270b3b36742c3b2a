"""The newest state of something that a stream keeps up to date.

A state is a folder named by its micro-batch; it counts once its write has succeeded. A
micro-batch makes the next state from the newest one before it, so a retry starts from the
same state. Only the newest state and the one before it stay.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

from shoreline.streaming.silver import BATCH


class StateFolder:
    """States of one stream below a folder; looked up by name, never by reading them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def batches(self) -> list[int]:
        """Micro-batches with a whole state, oldest first."""
        system, folder = self._place(self.path)
        names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
        found = sorted(int(m[1]) for n in names if (m := re.fullmatch(rf"{BATCH}=(\d+)", n)))
        return [b for b in found if system.exists(self._place(os.path.join(self._of(b), "_SUCCESS"))[1])]

    def before(self, batch_id: int) -> DataFrame | None:
        """The newest state of an earlier micro-batch."""
        earlier = [b for b in self.batches() if b < batch_id]
        return self.spark.read.parquet(self._of(earlier[-1])) if earlier else None

    def put(self, state: DataFrame, batch_id: int) -> None:
        """Store a micro-batch's state and drop those older than the one before it."""
        state.write.mode("overwrite").parquet(self._of(batch_id))
        system, _ = self._place(self.path)
        for old in [b for b in self.batches() if b < batch_id][:-1]:
            system.delete(self._place(self._of(old))[1], True)

    def current(self) -> DataFrame:
        """The newest state."""
        found = self.batches()
        if not found:
            raise ValueError(f"no state in {self.path}")
        return self.spark.read.parquet(self._of(found[-1]))

    def _of(self, batch_id: int) -> str:
        return os.path.join(self.path, f"{BATCH}={batch_id}")

    def _place(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place
