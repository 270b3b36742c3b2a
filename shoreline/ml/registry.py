"""Run log, best run and versioned models as tables and folders."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.operators.ranking import top_k_per_group
from shoreline.session import read_json_log
from shoreline.sinks.commits import commit_file

RUN_COLUMNS = {"run_id": "string", "team": "string", "model_type": "string",
               "params": "map<string,string>", "f1_score": "double", "roc_auc": "double",
               "accuracy": "double", "n_features": "int", "logged_at": "timestamp"}
REGISTRY_SCHEMA = "name string, version int, run_id string, path string"


def run_row(spark: SparkSession, run_id: str, team: str, model_type: str, params: Mapping[str, object],
            f1_score: float, roc_auc: float, accuracy: float, n_features: int) -> DataFrame:
    """One run as a row for the log."""
    row = (run_id, team, model_type, {k: str(v) for k, v in params.items()}, f1_score, roc_auc, accuracy, n_features)
    schema = ", ".join(f"{n} {k}" for n, k in RUN_COLUMNS.items() if n != "logged_at")
    return spark.createDataFrame([row], schema).withColumn("logged_at", F.current_timestamp())


def best_run(runs: DataFrame, by: Sequence[str] = ("team",), metric: str = "f1_score",
             tie_break: str = "run_id") -> DataFrame:
    """The run with the highest metric; equal ones go to the smaller run id."""
    order = [F.col(metric).desc_nulls_last(), F.asc(tie_break)]
    if not by:
        return runs.orderBy(*order).limit(1)
    return top_k_per_group(runs, list(by), order, 1).drop("rank")


def final_metric(best: DataFrame, reported: DataFrame, by: Sequence[str] = ("team",),
                 metric: str = "f1_score") -> DataFrame:
    """Larger of the logged and the self-reported metric; a side without a row does not count."""
    logged = best.select(*by, F.col(metric).alias("logged"))
    claimed = reported.groupBy(*by).agg(F.max(metric).alias("reported"))
    return logged.join(claimed, list(by), "full").withColumn("final", F.greatest("logged", "reported"))


def register_model(spark: SparkSession, model: PipelineModel, root: str, name: str, run_id: str) -> int:
    """Save a model as the next version of a name.

    The model goes to a folder of its own first; then the registry line takes the next free
    version in one step. Of two writers each gets a version, and neither replaces the other's model.
    """
    path = os.path.join(root, name, uuid.uuid4().hex)
    model.write().save(path)
    version = (registered_models(spark, root).filter(F.col("name") == name).agg(F.max("version")).collect()[0][0] or 0) + 1
    while True:
        line = json.dumps({"name": name, "version": version, "run_id": run_id, "path": path}) + "\n"
        if commit_file(spark, os.path.join(root, "registry", f"{name}-v{version}.json"), line):
            return version
        version += 1


def registered_models(spark: SparkSession, root: str) -> DataFrame:
    """All registered versions."""
    return read_json_log(spark, os.path.join(root, "registry"), REGISTRY_SCHEMA)


def load_model(spark: SparkSession, root: str, name: str, version: int | None = None) -> PipelineModel:
    """The newest version of a name, or the one asked for."""
    found = registered_models(spark, root).filter(F.col("name") == name)
    if version is not None:
        found = found.filter(F.col("version") == version)
    newest = found.orderBy(F.desc("version")).limit(1).collect()
    if not newest:
        raise ValueError(f"no model {name} {version or ''}")
    return PipelineModel.load(newest[0]["path"])
