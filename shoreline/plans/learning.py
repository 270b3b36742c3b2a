"""Train, log, pick, vote, cross-validate, register, store and score as one job."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.ml.metrics import classification_metrics, roc_auc
from shoreline.ml.models import (BOOSTED, FOREST, LOGISTIC, cross_validate, fit, gradient_boosting, logistic_regression, random_forest,
                                 scored, soft_vote)
from shoreline.ml.registry import best_run, register_model, run_row
from shoreline.ml.split import mark_split


def train_and_register(examples: DataFrame, everything: DataFrame, features: Sequence[str], label: str, key: str, team: str,
                       root: str, name: str = "classifier") -> dict[str, object]:
    """Fit three classifiers on the training split, log a run each, register the best one.

    Below ``root`` it stores: split, runs (one row per classifier), votes (the soft vote on
    the test rows), folds (fold, f1_score on the training rows), result (one row: team,
    model_type, f1_score, roc_auc, accuracy, n_features, run_id, submitted_at) and scores of
    all rows of ``everything``. Returns their paths and the registered version. The split is
    written once; every fit and test reads it. Boosting is one long chain of short jobs, so the
    other fits and the folds run beside it.
    """
    spark = examples.sparkSession
    paths = {n: os.path.join(root, n) for n in ("split", "runs", "votes", "folds", "result", "scores")}
    mark_split(examples, label, [key]).write.parquet(paths["split"])
    marked = spark.read.parquet(paths["split"])
    train, test = marked.filter("is_train").drop("is_train"), marked.filter("NOT is_train").drop("is_train")
    made = {LOGISTIC: logistic_regression(features, label, train.count()), FOREST: random_forest(features, label),
            BOOSTED: gradient_boosting(features, label)}
    with ThreadPoolExecutor(1) as beside:
        boosted = beside.submit(inheritable_thread_target(spark)(fit), made[BOOSTED], train)
        models = {kind: fit(made[kind], train) for kind in (LOGISTIC, FOREST)}
        cross_validate(made[FOREST], train, label, [key]).write.parquet(paths["folds"])
        models[BOOSTED] = boosted.result()
    lines = []
    for kind in made:
        rows = scored(models[kind], test, [key, label])
        m = classification_metrics(rows, label, "prediction").collect()[0]
        lines.append(run_row(spark, uuid.uuid4().hex, team, kind, {"features": ",".join(features)}, m["f1_score"],
                             roc_auc(rows, label, "probability"), m["accuracy"], len(features)))
    reduce(DataFrame.unionByName, lines).write.parquet(paths["runs"])
    best = best_run(spark.read.parquet(paths["runs"]))
    best.select("team", "model_type", "f1_score", "roc_auc", "accuracy", "n_features", "run_id",
                F.current_timestamp().alias("submitted_at")).write.parquet(paths["result"])
    chosen = spark.read.parquet(paths["result"]).select("model_type", "run_id").collect()[0]
    soft_vote(models, test).select(key, label, "probability", "prediction").write.parquet(paths["votes"])
    version = register_model(spark, models[chosen["model_type"]], root, name, chosen["run_id"])
    scored(models[chosen["model_type"]], everything, [key]).write.parquet(paths["scores"])
    return {**paths, "version": version}
