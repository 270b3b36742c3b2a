"""Named data-quality rules, profiles, reconciliation and artifact reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shoreline.functions.numbers import count_where, percent
from shoreline.operators.joins import duplicate_keys, with_scalars

DROP, WARN = "drop", "warn"


@dataclass(frozen=True)
class Rule:
    """A named SQL constraint; a row that gives NULL fails it."""

    name: str
    constraint: str
    action: str = DROP

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.constraint), F.lit(False))


def apply_rules(df: DataFrame, rules: Sequence[Rule], observation: Observation | None = None) -> DataFrame:
    """Drop the rows that fail a drop rule; warn rules keep every row.

    An ``observation`` collects the failures of all rules during the same pass.
    """
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"),
                        *[count_where(~r.holds()).alias(r.name) for r in rules])
    dropping = [r.holds() for r in rules if r.action == DROP]
    return df.filter(reduce(lambda a, b: a & b, dropping)) if dropping else df


def rule_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, action, passed, failed) for all rules in one pass over the table."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[count_where(r.holds()).alias(f"_passed_{i}") for i, r in enumerate(rules)])
    lines = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                               F.col(f"_passed_{i}").alias("passed"),
                               (F.col("_rows") - F.col(f"_passed_{i}")).alias("failed"))
                      for i, r in enumerate(rules)])
    return counts.select(F.inline(lines))


def quality_report(df: DataFrame, key: str, counts: Mapping[str, Column], dirty: Column,
                   digits: int = 1) -> DataFrame:
    """One row: total, the named counts, duplicates of the key and the clean share.

    As in a SQL report, a NULL test counts a row neither as bad nor as dirty.
    """
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total_records"),
        *[count_where(test).alias(name) for name, test in counts.items()],
        (total - F.count_distinct(key)).alias("duplicate_events"),
        percent(total - count_where(dirty), total, digits).alias("clean_pct"))


def profile(df: DataFrame, key: str, not_null: Sequence[str], invalid: Mapping[str, Column]) -> DataFrame:
    """Row, null, invalid and duplicate counts in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("distinct_keys"),
        *[count_where(F.col(c).isNull()).alias(f"null_{c}") for c in not_null],
        *[count_where(test).alias(f"invalid_{c}") for c, test in invalid.items()])


def invalid_code(value: Column, sentinels: Sequence, low: float, high: float) -> Column:
    """A sentinel code, or a value out of range."""
    return value.isin(*sentinels) | ~value.between(low, high)


def reconcile_layers(raw: DataFrame, clean: DataFrame, rollup: DataFrame | None = None,
                     rollup_keys: Mapping[str, str] | None = None, digits: int = 1) -> DataFrame:
    """One row: rows per layer, rows removed and pass rate.

    Each layer is scanned once: its counts are one aggregate, joined as scalar subqueries.
    """
    report = with_scalars(raw.agg(F.count("*").alias("raw_rows")), (clean, {"clean_rows": F.count("*")}))
    if rollup is not None:
        keys = {n: F.count_distinct(c) for n, c in (rollup_keys or {}).items()}
        report = with_scalars(report, (rollup, {"rollup_rows": F.count("*"), **keys}))
    return (report.withColumn("removed_rows", F.col("raw_rows") - F.col("clean_rows"))
            .withColumn("pass_rate_pct", percent(F.col("clean_rows"), F.col("raw_rows"), digits)))


def artifact_report(spark: SparkSession, expected: Mapping[str, int], tolerated: float = 0.9) -> DataFrame:
    """(table, rows, columns, status) per expected table: OK, LOW or MISSING.

    LOW means fewer rows than ``tolerated`` of the expected number. Existence is a
    catalog lookup; all counts run in one job.
    """
    lines = []
    for name, wanted in expected.items():
        if spark.catalog.tableExists(name):
            table = spark.table(name)
            low = F.col("rows") < F.lit(wanted * tolerated)
            lines.append(table.agg(F.count("*").alias("rows")).select(
                F.lit(name).alias("table_name"), "rows", F.lit(len(table.columns)).alias("columns"),
                F.when(low, "LOW").otherwise("OK").alias("status")))
        else:
            lines.append(spark.range(1).select(
                F.lit(name).alias("table_name"), F.lit(0).cast("long").alias("rows"),
                F.lit(0).alias("columns"), F.lit("MISSING").alias("status")))
    return reduce(DataFrame.unionByName, lines)


def column_report(tables: Mapping[str, DataFrame], expected: Mapping[str, Sequence[str]],
                  tolerated_missing: int = 2) -> DataFrame:
    """Per table: rows, which expected columns are missing, and a verdict."""
    lines = []
    for name, df in tables.items():
        missing = sorted(set(expected[name]) - set(df.columns))
        verdict = "OK" if not missing else "TOLERATED" if len(missing) <= tolerated_missing else "FAILED"
        lines.append(df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(missing)).alias("missing_count"),
            F.lit(", ".join(missing)).alias("missing"), F.lit(verdict).alias("verdict")))
    return reduce(DataFrame.unionByName, lines)


def domain_report(df: DataFrame, column: str, expected: Sequence) -> DataFrame:
    """Every seen or expected value with its rows: ok, missing or unexpected."""
    kind = df.schema[column].dataType.simpleString()
    wanted = df.sparkSession.createDataFrame([(v,) for v in expected], f"value {kind}").withColumn("_wanted", F.lit(1))
    seen = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    joined = seen.join(wanted, "value", "full")
    return joined.select(
        "value", F.coalesce("rows", F.lit(0)).alias("rows"),
        F.when(F.col("_wanted").isNull(), "unexpected").when(F.col("rows").isNull(), "missing")
        .otherwise("ok").alias("status"))


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, surplus rows and whether the key is unique."""
    rows, keys = F.count(F.lit(1)), F.count_distinct(key)
    return df.agg(rows.alias("rows"), keys.alias("distinct_keys"), (rows - keys).alias("surplus_rows"),
                  (rows == keys).alias("is_unique"))


def offending_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys that break uniqueness, with their row counts."""
    return duplicate_keys(df, key)
