"""Tree ensembles as tables of nodes, and what follows from the nodes alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.session import shared_folder


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per node of a forest or boosted ensemble.

    tree, weight, node, leaf, feature, threshold, left, right, gain, rows, value (a tree's
    prediction) and share (of class 1, from the class counts of a forest's node).
    """
    path = shared_folder(spark, "nodes")
    model.stages[-1].write().save(path)
    nodes = spark.read.parquet(f"{path}/data").toDF("treeID", "nodeData")
    trees = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight").select("tree", "weight")
    n = F.col("nodeData")
    counts = n["impurityStats"]
    listed = nodes.select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), (n["leftChild"] < 0).alias("leaf"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["gain"].alias("gain"), n["rawCount"].alias("rows"), n["prediction"].alias("value"),
        F.try_divide(F.get(counts, F.lit(1)), F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)).alias("share"))
    return listed.join(trees, "tree")


def score_by_nodes(df: DataFrame, nodes: DataFrame, features: Sequence[str], key: Sequence[str], depth: int, boosted: bool) -> DataFrame:
    """Keys with the probability of class 1, by walking each row down each tree with joins.

    The nodes are the broadcast side: they are as many as the model has, while the walking
    rows are rows times trees and grow with the table, which their estimated size hides.
    """
    at = df.select(*key, F.array(*[F.col(c).cast("double") for c in features]).alias("_x"))
    walking = at.withColumn("tree", F.explode(F.sequence(F.lit(0), nodes.agg(F.max("tree")).scalar()))).withColumn("node", F.lit(0))
    for _ in range(depth):
        step = nodes.select("tree", "node", "leaf", "feature", "threshold", "left", "right")
        walking = walking.join(F.broadcast(step), ["tree", "node"]).withColumn("node", F.when(F.col("leaf"), F.col("node")).when(
            F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))).select(*key, "_x", "tree", "node")
    ends = walking.join(F.broadcast(nodes.select("tree", "node", "weight", "value", "share")), ["tree", "node"])
    if boosted:
        return ends.groupBy(*key).agg((1 / (1 + F.exp(-2 * F.sum(F.col("weight") * F.col("value"))))).alias("by_nodes"))
    return ends.groupBy(*key).agg(F.avg("share").alias("by_nodes"))


def importances_by_nodes(nodes: DataFrame, boosted: bool) -> DataFrame:
    """(feature index, importance): gains times rows, shared out over all trees; a forest's trees count alike."""
    gains = nodes.filter(~F.col("leaf")).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("share"))
    if not boosted:
        whole = gains.groupBy("tree").agg(F.sum("share").alias("_tree"))
        gains = gains.join(whole, "tree").withColumn("share", F.try_divide("share", "_tree"))
    shares = gains.groupBy("feature").agg(F.sum("share").alias("share"))
    return shares.withColumn("importance", F.col("share") / shares.agg(F.sum("share")).scalar()).select("feature", "importance")
