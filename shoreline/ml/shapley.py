"""Shapley importances from sampled feature coalitions."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.ml.models import scored, spread
from shoreline.session import shared_folder


def shapley_values(model: PipelineModel, df: DataFrame, background: DataFrame, features: Sequence[str], key: Sequence[str],
                   samples: int = 8, seed: int = 42) -> DataFrame:
    """Per row and feature: its share of the row's probability, with the row's prediction and base.

    Each sample is an order of the features and one background row. Features take the row's
    own value one after another in that order, and a feature's share is how much the
    probability moves when it does; the mean over samples is its value. The shares of a row add
    up to its probability less the base, the mean probability of the background rows used.

    All coalitions of all rows are one exploded table that the model scores once. ``samples``
    background rows, those with the smallest hash of their key, are the only rows that pass
    through the driver.
    """
    spark, count = df.sparkSession, len(features)
    chosen = background.select(*key, *features).orderBy(F.xxhash64(*key, F.lit(seed)), *key).limit(samples).collect()
    if not chosen:
        raise ValueError("no background rows")
    rng = random.Random(seed)
    places = []
    for _ in range(samples):
        order = list(range(count))
        rng.shuffle(order)
        places.append([order.index(i) for i in range(count)])
    others = [[float(chosen[p % len(chosen)][f]) for f in features] for p in range(samples)]

    def literal(table: Sequence[Sequence[float]], i: int) -> Column:
        """Entry (sample, i) of a small table."""
        return F.get(F.lit([row[i] for row in table]), F.col("_sample"))

    dealt = spread(df.select(*key, *features), samples * (count + 1))
    coalitions = dealt.withColumn("_sample", F.explode(F.sequence(F.lit(0), F.lit(samples - 1)))).withColumn(
        "_taken", F.explode(F.sequence(F.lit(0), F.lit(count))))
    mixed = coalitions.select(*key, "_sample", "_taken", *[
        F.when(literal(places, i) < F.col("_taken"), F.col(f).cast("double")).otherwise(literal(others, i)).alias(f) for i, f in enumerate(features)])
    path = shared_folder(spark, "shapley")
    scored(model, mixed, [*key, "_sample", "_taken"]).select(*key, "_sample", "_taken", "probability").write.parquet(path)
    steps = spark.read.parquet(path).groupBy(*key, "_sample").agg(F.sort_array(F.collect_list(F.struct("_taken", "probability"))).alias("_p"))
    shares = F.array(*[F.struct(F.lit(f).alias("feature"), (
        F.get("_p", literal(places, i) + 1)["probability"] - F.get("_p", literal(places, i))["probability"]).alias("share")) for i, f in enumerate(features)])
    moved = steps.select(*key, F.get("_p", F.lit(count))["probability"].alias("prediction"), F.get("_p", F.lit(0))["probability"].alias("base"), F.inline(shares))
    return moved.groupBy(*key, "feature").agg(F.avg("share").alias("value"), F.avg("prediction").alias("prediction"), F.avg("base").alias("base"))


def shapley_importances(values: DataFrame) -> DataFrame:
    """(feature, importance): mean size of a feature's values, highest first."""
    return values.groupBy("feature").agg(F.avg(F.abs("value")).alias("importance")).orderBy(F.desc("importance"), "feature")
