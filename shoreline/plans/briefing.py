"""Metric tables turned into sentences: topic answers and the executive briefing."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions.numbers import count_where, percent
from shoreline.session import checkpoint_root


def metric_answers(answers: Mapping[str, tuple[DataFrame, Column, str]]) -> DataFrame:
    """(topic, answer, source) from one-row metric tables.

    ``answers`` maps a topic to its metric table, the sentence over its columns and the
    name of the source. The sentences are checkpointed, so all metrics are computed once,
    however many questions there are and however often the result is read.
    """
    lines = [metrics.select(F.lit(topic).alias("topic"), sentence.alias("answer"), F.lit(source).alias("source"))
             for topic, (metrics, sentence, source) in answers.items()]
    checkpoint_root(lines[0].sparkSession)
    return reduce(DataFrame.unionByName, lines).checkpoint()


def executive_briefing(rows: DataFrame, hit: Column, team: str, headline: str, digits: int = 1) -> DataFrame:
    """One row: headline text, number of rows and prevalence.

    ``headline`` is a format string over the row count and the prevalence in percent.
    """
    total = F.count(F.lit(1))
    metrics = rows.agg(total.alias("total_rows"), percent(count_where(hit), total, digits).alias("prevalence_pct"))
    return metrics.select(
        F.lit(team).alias("team"),
        F.format_string(headline, F.col("total_rows"), F.col("prevalence_pct")).alias("briefing_text"),
        "total_rows", "prevalence_pct", F.current_timestamp().alias("generated_at"))


def cohort_prompt(role: str, **measures: Column) -> Column:
    """Prompt text for one table row: the role, then ``name=value`` for each measure."""
    parts = [F.lit(role)]
    for i, (name, value) in enumerate(measures.items()):
        parts += [F.lit((", " if i else " ") + name.replace("_", " ") + "="), value.cast("string")]
    return F.concat(*parts)


def risk_prompt(age: Column, chol: Column, bp: Column, hr: Column) -> Column:
    """Prompt that states one row's measures for a risk classifier."""
    parts = [F.lit("Give one of LOW, MEDIUM, HIGH for these readings:")]
    for name, value in (("age", age), ("chol", chol), ("bp", bp), ("pulse", hr)):
        parts += [F.lit(f" {name}="), value.cast("string"), F.lit(";")]
    return F.concat(*parts)
