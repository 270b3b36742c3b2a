"""Answer key of the clinical quiz, from one aggregate over the clean table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions.labels import bucketize, code_label
from shoreline.functions.numbers import count_where, percent, ratio
from shoreline.plans.medallion import INTAKE_COHORT
from shoreline.session import checkpoint_root

# Names of the chest pain codes, limits of the double risk.
PAIN_NAMES = {0: "typical angina", 1: "atypical angina", 2: "non-anginal pain", 3: "asymptomatic"}
HIGH_CHOL, HIGH_BP = 240, 140

# Difficulty and source table per question; the wording is ours.
QUESTIONS = {
    "Q1": ("Number of patients with heart disease", "easy", "silver"),
    "Q2": ("Average age with and without heart disease", "easy", "silver"),
    "Q3": ("Share of female patients (sex = 0) with heart disease", "medium", "silver"),
    "Q4": ("Most common chest pain type among heart disease patients", "medium", "silver"),
    "Q5": ("Average cholesterol of the oldest age group, per diagnosis", "easy", "gold"),
    "Q6": ("Number of patients with high cholesterol and high blood pressure", "medium", "silver"),
    "Q7": ("Age group with the highest heart disease rate", "hard", "silver"),
    "Q8": ("Average maximum heart rate of healthy patients under 50", "medium", "silver"),
}


def patient_cube(silver: DataFrame) -> DataFrame:
    """Counts and sums by age group, pain code, sex and diagnosis: all the quiz needs to know.

    The table has a few hundred rows whatever the number of patients.
    """
    group = bucketize(F.col("age"), INTAKE_COHORT.edges, INTAKE_COHORT.labels)
    return silver.groupBy(group.alias("age_group"), "cp", "sex", "target").agg(
        F.count("*").alias("patients"), F.sum("age").alias("age_sum"), F.count("age").alias("ages"),
        F.sum("thalach").alias("rate_sum"), F.count("thalach").alias("rates"),
        count_where((F.col("chol") > HIGH_CHOL) & (F.col("trestbps") > HIGH_BP)).alias("double_risk"))


def answer_key(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """(question_id, question, answer, difficulty, table_used), one row per question.

    The cube is checkpointed: it is small, and the clean table is read once for all answers.
    """
    checkpoint_root(silver.sparkSession)
    cube = patient_cube(silver).checkpoint()
    sick, healthy = F.col("target") == 1, F.col("target") == 0
    female, young = F.col("sex") == 0, F.col("age_group").isin(*INTAKE_COHORT.labels[:2])

    def total(name: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(name))), F.lit(0))

    def average(name: str, count: str, when: Column) -> Column:
        return F.round(ratio(F.sum(F.when(when, F.col(name))), F.sum(F.when(when, F.col(count)))), 1)

    anyone = F.lit(True)
    facts = cube.agg(
        total("patients", sick).cast("string").alias("Q1"),
        F.concat(F.lit("Heart Disease: "), average("age_sum", "ages", sick).cast("string"),
                 F.lit(", Healthy: "), average("age_sum", "ages", ~sick).cast("string")).alias("Q2"),
        F.concat(percent(total("patients", female & sick), total("patients", female)).cast("string"), F.lit("%")).alias("Q3"),
        total("double_risk", anyone).cast("string").alias("Q6"),
        average("rate_sum", "rates", healthy & young).cast("string").alias("Q8"))
    pain = cube.filter(sick).groupBy("cp").agg(F.sum("patients").alias("n")).orderBy(F.desc("n"), "cp").limit(1).select(
        F.concat(F.col("cp").cast("string"), F.lit(" ("), code_label(F.col("cp"), PAIN_NAMES, "?"), F.lit(")")).alias("answer"))
    rates = cube.groupBy("age_group").agg(percent(total("patients", sick), F.sum("patients")).alias("rate"))
    top_rate = rates.orderBy(F.desc("rate"), "age_group").limit(1).select(
        F.concat("age_group", F.lit(" ("), F.col("rate").cast("string"), F.lit("%)")).alias("answer"))
    oldest = gold.filter(F.col("age_group") == INTAKE_COHORT.labels[-1]).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("diagnosis", "avg_cholesterol"))),
        lambda r: r["avg_cholesterol"].cast("string")), ", ").alias("answer"))

    answers = facts.unpivot([], ["Q1", "Q2", "Q3", "Q6", "Q8"], "question_id", "answer")
    for question, answer in (("Q4", pain), ("Q5", oldest), ("Q7", top_rate)):
        answers = answers.unionByName(answer.select(F.lit(question).alias("question_id"), "answer"))
    return answers.select("question_id", *[
        code_label(F.col("question_id"), {q: v[i] for q, v in QUESTIONS.items()}).alias(n)
        for i, n in enumerate(("question", "difficulty", "table_used"))], "answer")
