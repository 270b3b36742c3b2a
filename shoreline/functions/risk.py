"""Rule classifier for risk levels, as an expression and as SQL functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RiskLimits:
    """Fixed values of the rule text; override them to use the rule on other measures."""

    high_age: float = 60
    high_chol: float = 250
    high_bp: float = 150
    medium_age_from: float = 45
    medium_age_to: float = 60
    medium_chol: float = 200
    medium_bp: float = 130
    medium_hr: float = 100
    medium_markers: int = 2


def risk_level(age: Column, chol: Column, bp: Column, hr: Column,
               limits: RiskLimits = RiskLimits()) -> Column:
    """HIGH, MEDIUM or LOW by age and markers; a NULL measure never counts as abnormal."""
    def over(value: Column, limit: float) -> Column:
        return F.coalesce(value > F.lit(limit), F.lit(False))

    markers = (over(chol, limits.medium_chol).cast("int") + over(bp, limits.medium_bp).cast("int")
               + over(hr, limits.medium_hr).cast("int"))
    return (
        F.when(over(age, limits.high_age)
               & (over(chol, limits.high_chol) | over(bp, limits.high_bp)), F.lit("HIGH"))
        .when(age.between(limits.medium_age_from, limits.medium_age_to)
              & (markers >= limits.medium_markers), F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def register_risk_function(spark: SparkSession, name: str = "risk_assessment",
                           limits: RiskLimits = RiskLimits()) -> str:
    """The same rule as a temporary SQL function ``name(age, chol, bp, hr)``.

    The body is inlined by the optimizer, so a SQL caller pays no UDF cost.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(age DOUBLE, chol DOUBLE, bp DOUBLE, hr DOUBLE)
        RETURNS STRING
        COMMENT 'Risk level LOW, MEDIUM or HIGH by rule'
        RETURN CASE
            WHEN age > {limits.high_age} AND (chol > {limits.high_chol} OR bp > {limits.high_bp}) THEN 'HIGH'
            WHEN age BETWEEN {limits.medium_age_from} AND {limits.medium_age_to}
                 AND IF(chol > {limits.medium_chol}, 1, 0) + IF(bp > {limits.medium_bp}, 1, 0)
                   + IF(hr > {limits.medium_hr}, 1, 0) >= {limits.medium_markers} THEN 'MEDIUM'
            ELSE 'LOW' END
    """)
    return name


def register_cohort_summary(spark: SparkSession, cohort_view: str, group: str, label: str,
                            count: str, averages: dict[str, str],
                            name: str = "cohort_summary") -> str:
    """Table function ``name(group)``: one summary line per label of the asked group.

    ``averages`` maps the shown caption to the column of ``cohort_view``.
    """
    tail = "".join(f", ' | {caption}: ', CAST({column} AS STRING)" for caption, column in averages.items())
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted STRING)
        RETURNS TABLE ({group} STRING, {label} STRING, summary STRING)
        RETURN SELECT {group}, {label},
                      CONCAT('Group: ', {group}, ' | Label: ', {label},
                             ' | Rows: ', CAST({count} AS STRING){tail}) AS summary
               FROM {cohort_view} WHERE {group} = wanted
    """)
    return name
