"""The cohort table of a stream, kept up to date from changes of its clean rows.

Counts and whole-unit sums of a cohort are mergeable: a row that becomes the earliest of its
key adds to them, and the row it takes the place of is taken out again. A micro-batch reads
its changes and the cohort sums before it, never the rows that came before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoreline.functions.labels import bucketize, flag_label
from shoreline.operators.quality import Rule, apply_rules
from shoreline.plans.medallion import CohortSpec
from shoreline.streaming.changes import SIGN
from shoreline.streaming.ingest import start
from shoreline.streaming.states import StateFolder


def cohort_sums(changes: DataFrame, spec: CohortSpec) -> DataFrame:
    """Signed counts and whole-unit sums per cohort."""
    if spec.scale is None:
        raise ValueError("averages can be kept by increments only as whole units: give the cohorts a scale")
    group, label, count = spec.names
    sums: list[Column] = [F.sum(SIGN).cast("long").alias(count)]
    for name, column in spec.averages.items():
        units = F.round(F.col(column) * F.lit(10.0**spec.scale)).cast("long")
        sums += [F.coalesce(F.sum(F.col(SIGN) * units), F.lit(0)).cast("long").alias(f"{name}_units"),
                 F.sum(F.when(F.col(column).isNotNull(), F.col(SIGN)).otherwise(0)).cast("long").alias(f"{name}_rows")]
    return changes.groupBy(bucketize(F.col(spec.bucket_column), spec.edges, spec.labels).alias(group),
                           flag_label(F.expr(spec.flag), *spec.flag_labels).alias(label)).agg(*sums)


def merged_sums(parts: DataFrame, spec: CohortSpec) -> DataFrame:
    """Sums of cohort sums; cohorts without rows go."""
    group, label, count = spec.names
    added = [c for c in parts.columns if c not in (group, label)]
    return parts.groupBy(group, label).agg(*[F.sum(c).alias(c) for c in added]).filter(F.col(count) > 0)


def keep_gold(changes: DataFrame, spec: CohortSpec, rules: Sequence[Rule], path: str, checkpoint: str, drain: bool = True,
              state_partitions: int | None = None) -> StreamingQuery:
    """Keep a stream's cohort sums current after each micro-batch of changes."""
    states = StateFolder(changes.sparkSession, path)

    def merge(batch: DataFrame, batch_id: int) -> None:
        sums, before = cohort_sums(apply_rules(batch, rules), spec), states.before(batch_id)
        states.put(merged_sums(sums if before is None else before.unionByName(sums), spec), batch_id)

    writer = changes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return start(changes.sparkSession, writer, drain, state_partitions=state_partitions)


def read_gold(spark: SparkSession, path: str, spec: CohortSpec) -> DataFrame:
    """The cohort table of the newest state: counts and averages."""
    group, label, count = spec.names
    averages = [F.try_divide(F.col(f"{n}_units").cast("double") / F.lit(10.0**spec.scale), F.col(f"{n}_rows")).alias(n) for n in spec.averages]
    shown = averages if spec.digits is None else [F.round(a, spec.digits).alias(n) for a, n in zip(averages, spec.averages)]
    return StateFolder(spark, path).current().select(group, label, count, *shown)
