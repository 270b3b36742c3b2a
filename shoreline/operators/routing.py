"""Topic routing of texts, answers from metric tables, guards and evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions.text import contains_any, count_hits, has_digit
from shoreline.operators.cohort import top_value
from shoreline.operators.joins import broadcast_if_small

Topics = Mapping[str, Sequence[str]]

# Keyword lists of the default topics, in order of precedence.
FIRST_MATCH_TOPICS: Topics = {
    "drug": ["drug", "medication", "rating", "review", "prescription"],
    "notes": ["clinical note", "department", "note type", "hospital note"],
    "gold": ["age group", "age_group", "cohort"],
    "heart": ["heart", "patient", "disease", "cardiac", "cholesterol", "blood pressure", "chest pain"],
}
MULTI_TOPICS: Topics = {
    "heart": ["heart", "cardiac", "patient", "disease", "age", "cholesterol", "blood pressure", "chest pain"],
    "drug": ["drug", "medication", "medicine", "rating", "review", "treatment"],
    "notes": ["clinical", "note", "department", "diagnosis", "physician"],
}
SCORED_TOPICS: Topics = {
    "clinical": ["patient", "heart", "disease", "cardiac", "chest pain", "age", "cholesterol",
                 "blood pressure", "diagnosis", "clinical"],
    "pharmacy": ["drug", "medication", "medicine", "treatment", "side effect", "rating", "review",
                 "prescription", "dosage"],
}


def first_topic(text: Column, topics: Topics = FIRST_MATCH_TOPICS, default: str = "other",
                whole_words: bool = False) -> Column:
    """The first topic in order with a matching keyword."""
    case = None
    for topic, words in topics.items():
        hit = contains_any(text, words, whole_words)
        case = F.when(hit, topic) if case is None else case.when(hit, topic)
    return F.lit(default) if case is None else case.otherwise(F.lit(default))


def all_topics(text: Column, topics: Topics = MULTI_TOPICS, whole_words: bool = False) -> Column:
    """Array of every topic with a matching keyword."""
    return F.array_compact(F.array(*[F.when(contains_any(text, words, whole_words), F.lit(topic))
                                     for topic, words in topics.items()]))


def topic_sections(df: DataFrame, text: str, topics: Topics = MULTI_TOPICS, fallback: str = "help",
                   whole_words: bool = False) -> DataFrame:
    """One row per matching topic; a row without any gets the fallback."""
    found = df.withColumn("_topics", all_topics(F.col(text), topics, whole_words))
    return (found.withColumn("topic", F.explode_outer("_topics")).drop("_topics")
            .withColumn("topic", F.coalesce("topic", F.lit(fallback))))


def topic_by_score(text: Column, topics: Topics = SCORED_TOPICS, tie: str = "both",
                   whole_words: bool = False) -> Column:
    """The topic with more keyword hits; equal counts, zero included, give ``tie``."""
    (first, first_words), (second, second_words) = topics.items()
    a, b = count_hits(text, first_words, whole_words), count_hits(text, second_words, whole_words)
    return F.when(a > b, first).when(b > a, second).otherwise(F.lit(tie))


def answer_from_metrics(routed: DataFrame, metrics: DataFrame, topic: str = "topic",
                        fallback: str = "Please ask about one of the known topics.") -> DataFrame:
    """Join each routed row to its topic's prepared sentence (topic, answer, source)."""
    joined = routed.join(broadcast_if_small(metrics), topic, "left")
    sentence = F.concat("answer", F.lit(" (source: "), "source", F.lit(")"))
    return joined.withColumn("answer", F.coalesce(sentence, F.lit(fallback))).drop("source")


def guard(df: DataFrame, text: str, topics: Topics, advice_words: Sequence[str],
          refusal: str = "I cannot provide medical advice.") -> DataFrame:
    """Flags off-topic texts and requests for advice, with a confidence and a status.

    Confidence is the share of all keywords that occur.
    """
    words = [w for ws in topics.values() for w in ws]
    hits = count_hits(F.col(text), words)
    advice = contains_any(F.col(text), advice_words)
    return (df.withColumn("is_advice", F.coalesce(advice, F.lit(False)))
            .withColumn("is_off_topic", hits == 0)
            .withColumn("confidence", hits / F.lit(float(len(words))))
            .withColumn("status", F.when(F.col("is_advice"), "refused")
                        .when(F.col("is_off_topic"), "off topic").otherwise("answered"))
            .withColumn("reply", F.when(F.col("is_advice"), F.lit(refusal))))


def audit_rows(df: DataFrame, question: str, answer: str, status: str) -> DataFrame:
    """Rows for the append-only audit log."""
    return df.select(F.col(question).alias("question"), F.col(answer).alias("answer"),
                     F.col(status).alias("status"))


def evaluate_answers(df: DataFrame, answer: str) -> DataFrame:
    """PASS where the answer holds data (a digit), else WEAK."""
    return df.withColumn("evaluation", F.when(has_digit(F.col(answer)), "PASS").otherwise("WEAK"))


def evaluation_counts(df: DataFrame, answer: str) -> DataFrame:
    """Rows per evaluation."""
    return evaluate_answers(df, answer).groupBy("evaluation").agg(F.count("*").alias("rows"))


def mentions_of_top(facts: DataFrame, value: str, texts: DataFrame, text: str, group: str) -> DataFrame:
    """Find the most common value, then count the texts that mention it per group.

    The value arrives as a scalar subquery, so the text table is filtered in its scan
    stage and no join is planned.
    """
    top = top_value(facts.filter(F.col(value).isNotNull()), value).select(
        F.lower(F.col(value).cast("string"))).scalar()
    return (texts.withColumn("mentioned", top)
            .filter(F.lower(text).contains(F.col("mentioned")))
            .groupBy(group, "mentioned").agg(F.count("*").alias("documents")))
