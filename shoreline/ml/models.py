"""Three classifiers, their soft vote, cross-validation and importances."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.ml.metrics import classification_metrics, roc_auc
from shoreline.ml.split import stratified_folds
from shoreline.operators.ranking import rank_in_hash_order
from shoreline.session import checkpoint_root, shared_folder

LOGISTIC, FOREST, BOOSTED = "logistic_regression", "random_forest", "gradient_boosting"
#: Rows below which one more task costs a fit more than it saves.
ROWS_A_TASK = 4_000


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def logistic_regression(features: Sequence[str], label: str, rows: int, c: float = 1.0,
                        max_iter: int = 1000) -> Pipeline:
    """L2 logistic regression on standardised features.

    ``c`` weighs the loss summed over ``rows`` training rows; Spark averages the loss, so
    the penalty is divided by both.
    """
    return Pipeline(stages=[
        _assembler(features),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True),
        LogisticRegression(featuresCol="scaled", labelCol=label, maxIter=max_iter,
                           regParam=1.0 / (c * max(rows, 1)), standardization=False)])


def random_forest(features: Sequence[str], label: str, trees: int = 200, depth: int = 10,
                  seed: int = 42) -> Pipeline:
    """Random forest; rows remember their nodes, so that the trees grown so far do not travel with every task."""
    return Pipeline(stages=[_assembler(features), RandomForestClassifier(
        labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True)])


def gradient_boosting(features: Sequence[str], label: str, rounds: int = 200, depth: int = 5,
                      rate: float = 0.1, seed: int = 42) -> Pipeline:
    """Boosted trees; long chains of rounds are cut by checkpoints in the shared folder."""
    return Pipeline(stages=[_assembler(features), GBTClassifier(
        labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed, checkpointInterval=10)])


def spread(df: DataFrame, made: int = 1) -> DataFrame:
    """The rows dealt evenly to as many tasks as the cluster runs at once, to fewer where rows are few.

    In every pass of a tree fit each task returns counts for all open nodes, however few rows it
    has, so many small partitions cost more than the rows do, and a single one leaves the other
    cores idle. ``made`` is the number of rows that a later step makes of each.
    """
    tasks = math.ceil(df.count() * made / ROWS_A_TASK)
    return df.repartition(max(1, min(tasks, df.sparkSession.sparkContext.defaultParallelism)))


def fit(estimator: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit on evenly dealt rows kept in executor memory and disk, as every iteration reads them."""
    checkpoint_root(train.sparkSession)
    train = spread(train).persist()
    try:
        return without_summary(estimator.fit(train))
    finally:
        train.unpersist()


def without_summary(model: PipelineModel) -> PipelineModel:
    """The model without the training summaries of its stages.

    A summary holds the training rows and the session, and a session that has run an
    Observation cannot be sent to tasks. A forest's copy leaves it behind; that of a logistic
    regression keeps it, but a saved one does not.
    """
    spark = SparkSession.active()
    stages = []
    for stage in model.stages:
        if getattr(stage, "hasSummary", False):
            stage = stage.copy()
        if getattr(stage, "hasSummary", False):
            path = shared_folder(spark, "stage")
            stage.write().save(path)
            stage = type(stage).load(path)
        stages.append(stage)
    return PipelineModel(stages)


def scored(model: Model, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Rows with ``probability`` of class 1 and ``prediction``; batch scoring is a narrow map."""
    kept = list(keep or df.columns)
    return model.transform(df).select(
        *kept, vector_to_array("probability")[1].alias("probability"), F.col("prediction").cast("int").alias("prediction"))


def soft_vote(models: Mapping[str, Model], df: DataFrame, cut: float = 0.5) -> DataFrame:
    """Mean of the members' class-1 probabilities; the members run as one chain of maps, without joins."""
    for name, model in models.items():
        df = (model.transform(df)
              .withColumn(f"p_{name}", vector_to_array("probability")[1])
              .drop("features", "scaled", "rawPrediction", "probability", "prediction"))
    total = reduce(lambda a, b: a + b, [F.col(f"p_{name}") for name in models])
    return (df.withColumn("probability", total / F.lit(float(len(models))))
            .withColumn("prediction", (F.col("probability") >= cut).cast("int")))


def cross_validate(estimator: Pipeline, df: DataFrame, label: str, key: Sequence[str], folds: int = 5,
                   seed: int = 42) -> DataFrame:
    """(fold, rows, f1_score, roc_auc), folds from 1: one fit per stratified fold of the given (training) rows."""
    checkpoint_root(df.sparkSession)
    marked = spread(stratified_folds(df, label, key, folds, seed)).persist()
    try:
        lines = []
        for fold in range(folds):
            model = without_summary(estimator.fit(marked.filter(F.col("fold") != fold)))
            tested = scored(model, marked.filter(F.col("fold") == fold), [label])
            f1, rows = classification_metrics(tested, label, "prediction").select("f1_score", F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).collect()[0]
            lines.append((fold + 1, rows, f1, roc_auc(tested, label, "probability")))
    finally:
        marked.unpersist()
    return df.sparkSession.createDataFrame(lines, "fold int, rows long, f1_score double, roc_auc double")


def fold_summary(results: DataFrame) -> DataFrame:
    """Mean and population standard deviation over folds."""
    return results.agg(F.avg("f1_score").alias("mean_f1"), F.stddev_pop("f1_score").alias("std_f1"))


def importances(models: Mapping[str, PipelineModel], features: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance): mean over the members that have importances, highest first."""
    parts = [m.stages[-1].featureImportances.toArray() for m in models.values()
             if hasattr(m.stages[-1], "featureImportances")]
    if not parts:
        raise ValueError("no model with feature importances")
    means = sum(parts) / len(parts)
    lines = [(f, float(v)) for f, v in zip(features, means)]
    return df.sparkSession.createDataFrame(lines, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def permutation_importances(model: PipelineModel, df: DataFrame, features: Sequence[str], label: str, key: Sequence[str],
                            seed: int = 42) -> DataFrame:
    """(feature, importance) of any model: the AUC it loses when one feature is shuffled.

    A feature is shuffled by giving each row the value of the row at its place in another
    hash order; both places come from ``rank_in_hash_order``, so a rerun shuffles alike.
    """
    base = rank_in_hash_order(df.withColumn("_all", F.lit(1)), ["_all"], key, seed).withColumnRenamed("_rank", "_place").drop("_size")
    other = rank_in_hash_order(df.withColumn("_all", F.lit(1)), ["_all"], key, seed + 1).select(
        F.col("_rank").alias("_place"), F.struct(*features).alias("_other"))
    both = base.join(other, "_place").drop("_place", "_all").persist()
    try:
        def area(rows: DataFrame) -> float:
            return roc_auc(scored(model, rows, [label]), label, "probability")

        whole = area(both)
        lines = [(f, float(whole - area(both.withColumn(f, F.col("_other")[f])))) for f in features]
    finally:
        both.unpersist()
    return df.sparkSession.createDataFrame(lines, "feature string, importance double").orderBy(F.desc("importance"), "feature")
