"""Session settings and the shared folder that every executor can reach."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "shoreline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are written for.

    Shuffle partitions are left to AQE: it starts from a high count and coalesces small
    ones, so one setting serves small and large inputs. ``conf`` overrides any setting
    (``__`` in a name stands for ``.``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session may fall back.

    On a cluster a machine-local folder would be lost with its executor, so a missing
    setting is an error there.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="shoreline-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def read_json_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of a log folder; empty where nothing was written yet."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder, for tables a job writes and reads back."""
    return os.path.join(checkpoint_root(spark), f"{purpose}-{uuid.uuid4().hex[:12]}")
