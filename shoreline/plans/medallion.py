"""Raw table to clean table to cohort roll-up."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.functions.labels import bucketize, flag_label
from shoreline.operators.cohort import cohort_table
from shoreline.operators.dedup import keep_earliest
from shoreline.operators.quality import Rule, apply_rules
from shoreline.operators.reshape import stamped

RANK_FIRST, RULES_FIRST = "rank_first", "rules_first"


@dataclass(frozen=True)
class CleanSpec:
    """How raw rows become clean rows.

    The order matters: with ``rank_first`` a key whose earliest copy is dirty is lost, with
    ``rules_first`` a later clean copy takes its place.
    """

    key: Sequence[str]
    time: str
    rules: Sequence[Rule]
    tie_break: Sequence[str] = ()
    order: str = RANK_FIRST


@dataclass(frozen=True)
class CohortSpec:
    """Bucketed measure by flag label, with a count and averages."""

    bucket_column: str
    edges: Sequence[float]
    labels: Sequence[str]
    flag: str
    flag_labels: tuple[str, str]
    averages: Mapping[str, str]
    names: tuple[str, str, str] = ("age_group", "diagnosis", "patient_count")
    digits: int | None = 1
    scale: int | None = None


# The intake rules and cohort buckets of the clinical event table.
INTAKE_CLEAN = CleanSpec(
    key=["event_id"], time="event_timestamp",
    rules=[
        Rule("valid_age", "age IS NOT NULL AND age BETWEEN 1 AND 120"),
        Rule("valid_blood_pressure", "trestbps BETWEEN 50 AND 300"),
        Rule("non_negative_cholesterol", "chol >= 0"),
        Rule("has_event_id", "event_id IS NOT NULL", "warn"),
    ])
INTAKE_COHORT = CohortSpec(
    bucket_column="age", edges=[40, 50, 60], labels=["Under 40", "40-49", "50-59", "60+"],
    flag="target = 1", flag_labels=("Heart Disease", "Healthy"),
    averages={"avg_cholesterol": "chol", "avg_blood_pressure": "trestbps", "avg_max_heart_rate": "thalach"})


def clean(raw: DataFrame, spec: CleanSpec) -> DataFrame:
    """Deduplicated rows that satisfy the rules."""
    if spec.order == RULES_FIRST:
        return keep_earliest(apply_rules(raw, spec.rules), spec.key, spec.time, spec.tie_break)
    return apply_rules(keep_earliest(raw, spec.key, spec.time, spec.tie_break), spec.rules)


def clean_stamped(raw: DataFrame, spec: CleanSpec) -> DataFrame:
    """Clean rows with their load time, as stored."""
    return stamped(clean(raw, spec))


def build_layers(raw: DataFrame, cleaning: CleanSpec, cohorts: CohortSpec, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write raw, clean and cohort tables below a folder and give them back as stored.

    Each layer is computed once from the stored layer before it.
    """
    spark, layers = raw.sparkSession, []
    steps = (("raw", lambda df: df), ("clean", lambda df: clean_stamped(df, cleaning)),
             ("cohort", lambda df: rollup(df, cohorts)))
    current = raw
    for name, step in steps:
        path = os.path.join(folder, name)
        step(current).write.mode("overwrite").parquet(path)
        current = spark.read.parquet(path)
        layers.append(current)
    return tuple(layers)


def rollup(clean_rows: DataFrame, spec: CohortSpec) -> DataFrame:
    """Cohort table: one row per bucket and label."""
    group, label, count = spec.names
    groups = {group: bucketize(F.col(spec.bucket_column), spec.edges, spec.labels),
              label: flag_label(F.expr(spec.flag), *spec.flag_labels)}
    return cohort_table(clean_rows, groups, spec.averages, count, spec.digits, spec.scale)
