"""Derived inputs: the given tables are clean, so dirty and contest-shaped tables are views over them.

Each view exists twice, as a DataFrame and as SQL for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.base import table
from shoreline.operators.joins import broadcast_if_small
from shoreline.operators.quality import Rule
from shoreline.plans.medallion import CleanSpec, CohortSpec
from shoreline.session import shared_folder
from shoreline.sources.generate import Defect, inject_defects

VIEWS = {
    "intake_raw": """
        SELECT event_id, ts, user_id, event_type,
               CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 999.0
                    WHEN event_id % 61 = 0 THEN -1.0 ELSE value END AS value
        FROM events
        UNION ALL
        SELECT event_id, ts + INTERVAL 1 HOUR, user_id, event_type, value + 1.0
        FROM events WHERE event_id % 100 = 7""",
    "silver": """
        SELECT event_id, ts, user_id, event_type, value
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts) AS rn FROM intake_raw)
        WHERE rn = 1 AND value IS NOT NULL AND value BETWEEN 0 AND 500""",
    "gold": """
        SELECT CASE WHEN value < 100 THEN 'under 100' WHEN value < 200 THEN '100-199'
                    WHEN value < 300 THEN '200-299' ELSE '300+' END AS value_group,
               CASE WHEN event_type = 'error' THEN 'Failure' ELSE 'Normal' END AS outcome,
               COUNT(*) AS event_count,
               SUM(CAST(ROUND(value * 100) AS BIGINT))::DOUBLE / 100 / COUNT(*) AS avg_value,
               SUM(CAST(ROUND(user_id * 100) AS BIGINT))::DOUBLE / 100 / COUNT(*) AS avg_user
        FROM silver GROUP BY 1, 2""",
    "cohort_base": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flag,
               CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS code
        FROM lineitem""",
    "clinical": """
        SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) + 25 AS age, l_linenumber % 2 AS sex,
               CAST(l_partkey % 4 AS INT) AS cp, CAST(90 + l_suppkey % 100 AS INT) AS trestbps,
               CAST(150 + l_partkey % 200 AS INT) AS chol, CAST(100 + l_orderkey % 80 AS INT) AS thalach,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target
        FROM lineitem""",
    "clinical_gold": """
        SELECT CASE WHEN age < 40 THEN 'Under 40' WHEN age < 50 THEN '40-49' WHEN age < 60 THEN '50-59' ELSE '60+' END AS age_group,
               CASE WHEN target = 1 THEN 'Heart Disease' ELSE 'Healthy' END AS diagnosis, COUNT(*) AS patient_count,
               ROUND(AVG(chol), 1) AS avg_cholesterol, ROUND(AVG(trestbps), 1) AS avg_blood_pressure,
               ROUND(AVG(thalach), 1) AS avg_max_heart_rate
        FROM clinical GROUP BY 1, 2""",
    "score_log": """
        SELECT user_id AS team, event_type AS event, CAST(event_id % 4 AS INT) AS category,
               value AS points, CAST(500 AS DOUBLE) AS max_points, ts AS scored_at, event_id
        FROM events""",
    "registered": "SELECT c_custkey AS team FROM customer",
    "answer_key": """
        SELECT event_type AS question_id, CAST(COUNT(*) AS STRING) AS answer FROM events GROUP BY event_type""",
    "submissions": """
        SELECT e.event_id, e.user_id AS team, e.event_type AS question_id,
               CASE e.event_id % 6 WHEN 0 THEN k.answer WHEN 1 THEN CONCAT('about ', k.answer, ' rows')
                    WHEN 2 THEN CONCAT(k.answer, '%') WHEN 3 THEN 'ERROR: timeout' WHEN 4 THEN 'no idea'
                    ELSE CAST(CAST(k.answer AS BIGINT) + 7 AS STRING) END AS answer,
               CASE WHEN e.event_id % 2 = 0 THEN 'SQL' ELSE 'ASSISTANT' END AS method, e.ts AS submitted_at
        FROM events e JOIN answer_key k ON e.event_type = k.question_id""",
    "best": """
        SELECT team, event, category, MAX(points) AS points, MAX(max_points) AS max_points
        FROM score_log GROUP BY team, event, category""",
    "totals": """
        SELECT team, ROUND(SUM(points), 6) AS total_points, COUNT(DISTINCT event) AS events_done
        FROM best GROUP BY team""",
    "routed": """
        SELECT conv_id, turn,
               CASE WHEN LOWER(text) LIKE '%the%' THEN 'a' WHEN LOWER(text) LIKE '%eau%' THEN 'b'
                    WHEN LOWER(text) LIKE '%ung%' THEN 'c' ELSE 'other' END AS topic
        FROM conversations""",
}
_NEEDS = {"clinical_gold": ["clinical"], "silver": ["intake_raw"], "gold": ["silver"], "submissions": ["answer_key"], "best": ["score_log"],
          "totals": ["best"]}

TOPICS = {"a": ["the"], "b": ["eau"], "c": ["ung"]}


def with_views(views: str, body: str) -> str:
    """SQL text with the named views, and those they need, as CTEs before the body."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        add(name)
    ctes = ", ".join(f"{name} AS ({VIEWS[name]})" for name in ordered)
    body = body.strip()
    return f"WITH {ctes}, {body[5:]}" if body.startswith("WITH ") else f"WITH {ctes} {body}"


INTAKE_RULES = [Rule("has_value", "value IS NOT NULL"), Rule("valid_value", "value BETWEEN 0 AND 500"),
                Rule("has_event_id", "event_id IS NOT NULL", "warn")]
CLEAN = CleanSpec(key=["event_id"], time="ts", rules=INTAKE_RULES, tie_break=["value"])
COHORT = CohortSpec(
    bucket_column="value", edges=[100, 200, 300], labels=["under 100", "100-199", "200-299", "300+"],
    flag="event_type = 'error'", flag_labels=("Failure", "Normal"),
    averages={"avg_value": "value", "avg_user": "user_id"},
    names=("value_group", "outcome", "event_count"), digits=None, scale=2)


def intake_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Events with nulls, sentinels and late repeats."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return inject_defects(
        events, "event_id",
        [Defect("value", None, 97), Defect("value", 999.0, 53), Defect("value", -1.0, 61)],
        duplicate_when=F.col("event_id") % 100 == 7,
        duplicate_changes={"ts": F.col("ts") + F.expr("INTERVAL 1 HOUR"), "value": F.col("value") + 1.0})


def cohort_base(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a binary flag and a code."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("flag"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1)
        .when(F.col("l_returnflag") == "R", 2).alias("code"))


def clinical(spark: SparkSession, sf: str) -> DataFrame:
    """Line items shaped like patients."""
    def whole(column):
        return column.cast("int")

    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (whole(F.col("l_quantity")) + 25).alias("age"),
        (F.col("l_linenumber") % 2).alias("sex"), whole(F.col("l_partkey") % 4).alias("cp"),
        whole(90 + F.col("l_suppkey") % 100).alias("trestbps"), whole(150 + F.col("l_partkey") % 200).alias("chol"),
        whole(100 + F.col("l_orderkey") % 80).alias("thalach"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("target"))


def score_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as leaderboard entries."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("team"), F.col("event_type").alias("event"),
        (F.col("event_id") % 4).cast("int").alias("category"), F.col("value").alias("points"),
        F.lit(500.0).alias("max_points"), F.col("ts").alias("scored_at"), "event_id")


def registered(spark: SparkSession, sf: str) -> DataFrame:
    """All customers as teams; most have no score."""
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("team"))


def answer_key(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per event type as the expected answers, stored as the answer key is."""
    path = shared_folder(spark, "answer_key")
    (table(spark, sf, "events").groupBy(F.col("event_type").alias("question_id"))
     .agg(F.count("*").cast("string").alias("answer"))
     .withColumn("question", F.concat(F.lit("How many events are of type "), "question_id", F.lit("?"))).write.parquet(path))
    return spark.read.parquet(path)


def submissions(spark: SparkSession, sf: str, stored_key: DataFrame | None = None) -> DataFrame:
    """Six kinds of answers: exact, embedded, percent, error, text, wrong."""
    stored_key = stored_key if stored_key is not None else answer_key(spark, sf)
    key = broadcast_if_small(stored_key.select("question_id", F.col("answer").alias("_k")))
    kind, k = F.col("event_id") % 6, F.col("_k")
    answer = (F.when(kind == 0, k).when(kind == 1, F.concat(F.lit("about "), k, F.lit(" rows")))
              .when(kind == 2, F.concat(k, F.lit("%"))).when(kind == 3, "ERROR: timeout")
              .when(kind == 4, "no idea").otherwise((k.cast("long") + 7).cast("string")))
    events = table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("team"), F.col("event_type").alias("question_id"),
        F.col("ts").alias("submitted_at"))
    return events.join(key, "question_id").select(
        "event_id", "team", "question_id", answer.alias("answer"),
        F.when(F.col("event_id") % 2 == 0, "SQL").otherwise("ASSISTANT").alias("method"), "submitted_at")


def waves(df: DataFrame, key: str, count: int = 5) -> str:
    """Write a table as NDJSON in ``count`` sub-folders, as if it had arrived in waves; gives the folder."""
    path = shared_folder(df.sparkSession, "landing")
    wave = F.pmod(F.xxhash64(key), F.lit(count))
    df.withColumn("wave", wave).write.partitionBy("wave").option("timestampNTZFormat", MICROSECONDS).json(path)
    return path


MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
INTAKE_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
EVENT_SCHEMA = INTAKE_SCHEMA + ", props string"
