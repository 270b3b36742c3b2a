"""Checking submitted answers and turning verdicts into points."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions.answers import verdict
from shoreline.functions.labels import tier_points
from shoreline.functions.text import normalize, numeric_tokens
from shoreline.operators.dedup import keep_latest
from shoreline.operators.joins import broadcast_if_small
from shoreline.operators.model_calls import score_rows


HELPERS = ("_given", "_given_numbers", "_wanted", "_wanted_numbers")

# Points by F1 score; any score above zero earns the last value.
F1_TIERS = [(0.90, 15), (0.85, 12), (0.80, 10), (0.70, 7)]
F1_ANY = 4


def f1_points(f1: Column) -> Column:
    """Points for a model's F1 score."""
    return tier_points(f1, F1_TIERS, otherwise=F.when(f1 > 0, F1_ANY).otherwise(F.lit(0)))


def validate_submissions(df: DataFrame, question_ids: Sequence[str], methods: Sequence[str]) -> DataFrame:
    """Upper-case id and method, and give a ``reason`` where either is unknown (else NULL)."""
    fixed = df.withColumns({"question_id": F.upper("question_id"), "method": F.upper("method")})
    known_id = F.coalesce(F.col("question_id").isin(*question_ids), F.lit(False))
    known_method = F.coalesce(F.col("method").isin(*methods), F.lit(False))
    return fixed.withColumn("reason", F.when(~known_id, "unknown question")
                            .when(~known_method, "unknown method"))


def latest_answers(submissions: DataFrame, by: Sequence[str] = ("team", "question_id"),
                   time: str = "submitted_at", tie_break: Sequence[str] = ()) -> DataFrame:
    """Each team's last answer per question."""
    return keep_latest(submissions, by, time, tie_break)


def check_answers(submissions: DataFrame, key: DataFrame, tolerance: float = 0.5,
                  strict: bool = False) -> DataFrame:
    """Adds ``expected``, the key's ``question`` text if it has one, and the three-valued ``verdict``.

    The key (question_id, answer) is broadcast if it is small; a question that draws a
    third of the submissions then costs nothing extra. Expected answers are normalised
    and split into numbers once per question, given ones once per row.
    """
    wanted = normalize(F.col("answer"))
    text = [c for c in ("question",) if c in key.columns]
    expected = key.select("question_id", *text, F.col("answer").alias("expected"), wanted.alias("_wanted"),
                          numeric_tokens(wanted).alias("_wanted_numbers"))
    rows = submissions.withColumn("_given", normalize(F.col("answer")))
    rows = rows.withColumn("_given_numbers", numeric_tokens(F.col("_given")))
    joined = rows.join(broadcast_if_small(expected), "question_id")
    decision = verdict(*[F.col(c) for c in HELPERS], tolerance, strict)
    return joined.withColumn("verdict", decision).drop(*HELPERS)


def judge_prompt(question: Column, expected: Column, answer: Column) -> Column:
    """Text put to the second judge."""
    return F.concat(F.lit("Does the given answer say the same as the reference?\nAsked: "), question,
                    F.lit("\nReference: "), expected, F.lit("\nGiven: "), answer,
                    F.lit("\nAnswer CORRECT if it does and WRONG if not."))


def judge_unknown(checked: DataFrame, client: Callable[[list[str]], list[str]]) -> DataFrame:
    """Send only undecided rows to a second judge.

    Its reply counts by the first word: CORRECT makes the answer right, any other wrong. A
    failed call leaves the verdict unknown (NULL). Adds ``judge`` ('rule' or 'model'). The
    question's text is put to the judge where the key has one (``question``), else its id.
    """
    asked = F.coalesce("question", "question_id") if "question" in checked.columns else F.col("question_id")
    decided = checked.filter(F.col("verdict").isNotNull()).withColumn("judge", F.lit("rule"))
    unknown = checked.filter(F.col("verdict").isNull()).withColumn("_prompt", judge_prompt(asked, F.col("expected"), F.col("answer")))
    first_word = F.upper(F.regexp_extract("_reply", r"^\W*(\w+)", 1))
    judged = score_rows(unknown, "_prompt", client, output="_reply").withColumn("verdict", first_word == "CORRECT")
    return decided.unionByName(judged.select(*checked.columns, F.lit("model").alias("judge")))


def channel_points(assistant_right: Column, direct_right: Column, assistant_method: Column) -> Column:
    """3 for the assistant channel, else 2 for a direct answer (3 if it names that method), else 0."""
    return (F.when(F.coalesce(assistant_right, F.lit(False)), F.lit(3))
            .when(F.coalesce(direct_right, F.lit(False)),
                  F.when(F.coalesce(assistant_method, F.lit(False)), F.lit(3)).otherwise(F.lit(2)))
            .otherwise(F.lit(0)))


def first_correct(checked: DataFrame, question: str = "question_id", time: str = "submitted_at",
                  tie_break: Sequence[str] = ("team",), bonus: int = 1) -> DataFrame:
    """The first team with a right answer per question and its bonus.

    A minimum over structs is combined per task before the shuffle, so a popular question
    sends one row per task.
    """
    first = F.min(F.struct(time, *tie_break)).alias("_first")
    return (checked.filter(F.col("verdict")).groupBy(question).agg(first)
            .select(question, *[F.col(f"_first.{c}").alias(c) for c in tie_break],
                    F.col(f"_first.{time}").alias(time), F.lit(bonus).alias("bonus")))
