"""Answer checking, points and leaderboards."""

from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import answer_key, clinical, registered, score_log, submissions, with_views
from shoreline.operators.dedup import keep_latest
from shoreline.operators.leaderboard import (best_scores, completion_grid, completion_rate, event_dimension, event_totals,
                                             kpi_tiles, leaderboard, timeline)
from shoreline.operators.reshape import wide_to_long
from shoreline.operators.scoring import channel_points, check_answers, f1_points, judge_unknown, validate_submissions
from shoreline.plans import quiz
from shoreline.plans.medallion import INTAKE_COHORT, rollup

NORMAL = r"REPLACE(REPLACE(REPLACE(LOWER(REGEXP_REPLACE(COALESCE({0}, ''), '^\s+|\s+$', '', 'g')), '%', ''), ',', ''), ';', ' ')"
NUMBERS = r"""LIST_TRANSFORM(LIST_FILTER(REGEXP_SPLIT_TO_ARRAY({0}, '\s+'),
              lambda t: REGEXP_FULL_MATCH(t, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?')), lambda t: CAST(t AS DOUBLE))"""


def verdict_views(met: str) -> str:
    """CTEs ``normal`` and ``checked`` for the submissions; ``met`` decides between number lists an and kn."""
    return f"""
    WITH normal AS (SELECT s.*, k.answer AS expected, {NORMAL.format('s.answer')} AS a, {NORMAL.format('k.answer')} AS k
                    FROM submissions s JOIN answer_key k ON s.question_id = k.question_id),
         lists AS (SELECT *, {NUMBERS.format('a')} AS an, {NUMBERS.format('k')} AS kn FROM normal),
         checked AS (SELECT *, CASE WHEN a = '' OR a LIKE 'error%' OR a LIKE 'failed%' THEN FALSE WHEN a = k THEN TRUE
             WHEN LEN(an) > 0 AND LEN(kn) > 0 THEN {met}
             WHEN CONTAINS(a, k) OR CONTAINS(k, a) THEN TRUE END AS verdict FROM lists)"""


ANY_PAIR = "LEN(LIST_FILTER(an, lambda x: LEN(LIST_FILTER(kn, lambda y: ABS(x - y) <= 0.5)) > 0)) > 0"
EVERY_KEY = "LEN(LIST_FILTER(kn, lambda y: LEN(LIST_FILTER(an, lambda x: ABS(x - y) <= 0.5)) > 0)) = LEN(kn)"


def checked(spark, sf, **options):
    key = answer_key(spark, sf)
    return check_answers(submissions(spark, sf, key), key, **options)


@query("sco_01_answer_check", with_views("submissions", verdict_views(ANY_PAIR) + " SELECT event_id, answer, expected, verdict FROM checked"))
def answer_check(spark, sf):
    return checked(spark, sf).select("event_id", "answer", "expected", "verdict")


@query("sco_01_answer_check_strict", with_views("submissions", verdict_views(EVERY_KEY) + " SELECT event_id, verdict FROM checked"))
def answer_check_strict(spark, sf):
    return checked(spark, sf, strict=True).select("event_id", "verdict")


@query("sco_02_second_judge", with_views("submissions", verdict_views(ANY_PAIR) + """
    SELECT question_id, CASE WHEN verdict IS NULL THEN 'model' ELSE 'rule' END AS judge,
           COALESCE(verdict, question_id = 'view') AS verdict, COUNT(*) AS n_rows FROM checked GROUP BY 1, 2, 3"""))
def second_judge(spark, sf):
    def client(prompts):
        return ["Correct." if "type view?" in p else "Incorrect" for p in prompts]

    return judge_unknown(checked(spark, sf), client).groupBy("question_id", "judge", "verdict").agg(F.count("*").alias("n_rows"))


@query("sco_03_best_channel", with_views("submissions", verdict_views(ANY_PAIR) + """,
    latest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY team, question_id, method ORDER BY submitted_at DESC, event_id DESC) AS rn
               FROM checked) WHERE rn = 1),
    both_ways AS (SELECT team, question_id, BOOL_OR(method = 'ASSISTANT' AND COALESCE(verdict, FALSE)) AS assistant_right,
                         BOOL_OR(method = 'SQL' AND COALESCE(verdict, FALSE)) AS direct_right,
                         BOOL_OR(method = 'SQL' AND event_id % 4 = 0) AS assistant_method FROM latest GROUP BY team, question_id)
    SELECT team, question_id, CASE WHEN assistant_right THEN 3 WHEN direct_right AND assistant_method THEN 3
                                   WHEN direct_right THEN 2 ELSE 0 END AS points FROM both_ways"""))
def best_channel(spark, sf):
    latest = keep_latest(checked(spark, sf), ["team", "question_id", "method"], "submitted_at", ["event_id"])
    right = F.coalesce("verdict", F.lit(False))
    both = latest.groupBy("team", "question_id").agg(
        F.bool_or((F.col("method") == "ASSISTANT") & right).alias("assistant_right"),
        F.bool_or((F.col("method") == "SQL") & right).alias("direct_right"),
        F.bool_or((F.col("method") == "SQL") & (F.col("event_id") % 4 == 0)).alias("assistant_method"))
    return both.select("team", "question_id", channel_points(
        F.col("assistant_right"), F.col("direct_right"), F.col("assistant_method")).alias("points"))


QUIZ_SQL = {
    "Q1": "SELECT CAST(COUNT(*) AS VARCHAR) FROM clinical WHERE target = 1",
    "Q2": """SELECT 'Heart Disease: ' || ROUND(AVG(CASE WHEN target = 1 THEN age END), 1) || ', Healthy: '
                    || ROUND(AVG(CASE WHEN target = 0 THEN age END), 1) FROM clinical""",
    "Q3": "SELECT ROUND(SUM(target) * 100.0::DOUBLE / COUNT(*), 1) || '%' FROM clinical WHERE sex = 0",
    "Q4": """SELECT cp || ' (' || CASE cp WHEN 0 THEN 'typical angina' WHEN 1 THEN 'atypical angina'
                    WHEN 2 THEN 'non-anginal pain' ELSE 'asymptomatic' END || ')'
             FROM clinical WHERE target = 1 GROUP BY cp ORDER BY COUNT(*) DESC, cp LIMIT 1""",
    "Q5": "SELECT STRING_AGG(CAST(avg_cholesterol AS VARCHAR), ', ' ORDER BY diagnosis) FROM clinical_gold WHERE age_group = '60+'",
    "Q6": "SELECT CAST(COUNT(*) AS VARCHAR) FROM clinical WHERE chol > 240 AND trestbps > 140",
    "Q7": """SELECT age_group || ' (' || rate || '%)' FROM (
                SELECT age_group, ROUND(SUM(CASE WHEN diagnosis = 'Heart Disease' THEN patient_count ELSE 0 END) * 100.0::DOUBLE
                       / SUM(patient_count), 1) AS rate FROM clinical_gold GROUP BY age_group) ORDER BY rate DESC, age_group LIMIT 1""",
    "Q8": "SELECT CAST(ROUND(AVG(thalach), 1) AS VARCHAR) FROM clinical WHERE target = 0 AND age < 50",
}


@query("sco_00_quiz_answer_key", with_views("clinical_gold", " UNION ALL ".join(f"""
    SELECT '{q}' AS question_id, '{quiz.QUESTIONS[q][1]}' AS difficulty, '{quiz.QUESTIONS[q][2]}' AS table_used, ({sql}) AS answer"""
    for q, sql in QUIZ_SQL.items())))
def quiz_answer_key(spark, sf):
    silver = clinical(spark, sf)
    return quiz.answer_key(silver, rollup(silver, INTAKE_COHORT)).drop("question")


KINDS = ["click", "error", "purchase", "signup", "view"]


@query("sco_04_wide_to_long", " UNION ALL ".join(f"""
    SELECT user_id AS team, '{k}' AS category, COUNT(*) FILTER (WHERE event_type = '{k}') AS points FROM events GROUP BY user_id""" for k in KINDS))
def components(spark, sf):
    wide = table(spark, sf, "events").groupBy(F.col("user_id").alias("team")).agg(
        *[F.count_if(F.col("event_type") == k).alias(k) for k in KINDS])
    return wide_to_long(wide, ["team"], KINDS)


@query("sco_05_leaderboard", with_views("totals registered", """
    WITH last_sub AS (SELECT team, MAX(scored_at) AS last_scored FROM score_log GROUP BY team),
         top AS (SELECT SUM(m) AS max_possible FROM (SELECT event, category, MAX(max_points) AS m FROM score_log GROUP BY event, category)),
         board AS (SELECT r.team, COALESCE(t.total_points, 0) AS total_points, COALESCE(t.events_done, 0) AS events_done, l.last_scored
                   FROM registered r LEFT JOIN totals t ON r.team = t.team LEFT JOIN last_sub l ON r.team = l.team)
    SELECT team, total_points, events_done, last_scored, max_possible, ROUND(total_points * 100.0 / max_possible, 6) AS pct,
           ROW_NUMBER() OVER (ORDER BY total_points DESC, team) AS rank,
           ROUND(total_points - (SELECT MAX(total_points) FROM board), 6) AS gap_to_leader,
           CASE ROW_NUMBER() OVER (ORDER BY total_points DESC, team) WHEN 1 THEN 'gold' WHEN 2 THEN 'silver' WHEN 3 THEN 'bronze' END AS medal
    FROM board, top"""))
def board(spark, sf):
    return leaderboard(score_log(spark, sf), registered(spark, sf), 6).withColumn("gap_to_leader", F.round("gap_to_leader", 6))


@query("sco_06_completion_grid", with_views("best registered", """
    SELECT r.team, e.event, COALESCE(b.points, 0) AS points, t.submitted_at,
           CASE WHEN b.points > 0 THEN 'Submitted' ELSE 'Not Started' END AS status
    FROM registered r CROSS JOIN (SELECT DISTINCT event FROM score_log) e
    LEFT JOIN (SELECT team, event, ROUND(SUM(points), 6) AS points FROM best GROUP BY team, event) b ON r.team = b.team AND e.event = b.event
    LEFT JOIN (SELECT team, event, MIN(scored_at) AS submitted_at FROM score_log GROUP BY team, event) t ON r.team = t.team AND e.event = t.event"""))
def completion(spark, sf):
    log = score_log(spark, sf)
    return completion_grid(log, registered(spark, sf), event_dimension(log), 6)


@query("sco_06_completion_rate", with_views("best registered", """
    SELECT event, COUNT(DISTINCT team) AS teams_submitted, (SELECT COUNT(DISTINCT team) FROM registered) AS total_teams,
           ROUND(COUNT(DISTINCT team) * 100.0 / (SELECT COUNT(DISTINCT team) FROM registered)::DOUBLE, 6) AS completion_pct
    FROM (SELECT team, event FROM best GROUP BY team, event HAVING SUM(points) > 0) GROUP BY event"""))
def completed_share(spark, sf):
    log = score_log(spark, sf)
    return completion_rate(log, registered(spark, sf), event_dimension(log), digits=6)


@query("sco_07_event_detail", with_views("best", """
    SELECT event, team, ROUND(SUM(points), 6) AS points, ROUND(SUM(max_points), 6) AS max_points FROM best GROUP BY event, team"""))
def event_detail(spark, sf):
    return event_totals(best_scores(score_log(spark, sf))).select(
        "event", "team", F.round("points", 6).alias("points"), F.round("max_points", 6).alias("max_points")
    ).orderBy("event", F.desc("points"), "team")


@query("sco_07_path_distribution", with_views("score_log", "SELECT category, COUNT(DISTINCT team) AS teams FROM score_log GROUP BY category"))
def path_distribution(spark, sf):
    return score_log(spark, sf).groupBy("category").agg(F.count_distinct("team").alias("teams"))


@query("sco_07_timeline", with_views("score_log", """
    SELECT DATE_TRUNC('minute', scored_at)::TIMESTAMP AS bucket, COUNT(*) AS entries FROM score_log GROUP BY 1"""))
def minutes(spark, sf):
    return timeline(score_log(spark, sf)).withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query("sco_07_f1_points", """
    SELECT event_id, ROUND(value / 500, 6) AS f1, CASE WHEN ROUND(value / 500, 6) >= 0.9 THEN 15 WHEN ROUND(value / 500, 6) >= 0.85 THEN 12
           WHEN ROUND(value / 500, 6) >= 0.8 THEN 10 WHEN ROUND(value / 500, 6) >= 0.7 THEN 7 WHEN ROUND(value / 500, 6) > 0 THEN 4 ELSE 0 END AS points
    FROM events""")
def performance_points(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(F.col("value") / 500, 6).alias("f1")).withColumn(
        "points", f1_points(F.col("f1")))


@query("sco_08_kpi_tiles", with_views("best registered", """
    SELECT (SELECT ROUND(SUM(points), 6) FROM best) AS points_awarded, (SELECT COUNT(DISTINCT event) FROM score_log) AS events_scored,
           (SELECT MAX(scored_at) FROM score_log) AS last_submission, (SELECT COUNT(DISTINCT team) FROM registered) AS total_teams"""))
def tiles(spark, sf):
    return kpi_tiles(score_log(spark, sf), registered(spark, sf), 6)


@query("sco_09_validation", """
    SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'REFUND' ELSE UPPER(event_type) END AS question_id,
           CASE WHEN event_id % 11 = 0 THEN 'FAX' WHEN event_id % 2 = 0 THEN 'SQL' ELSE 'ASSISTANT' END AS method,
           CASE WHEN event_id % 7 = 0 THEN 'unknown question' WHEN event_id % 11 = 0 THEN 'unknown method' END AS reason FROM events""")
def validation(spark, sf):
    rows = submissions(spark, sf).select(
        "event_id", F.when(F.col("event_id") % 7 == 0, "refund").otherwise(F.col("question_id")).alias("question_id"),
        F.when(F.col("event_id") % 11 == 0, "fax").otherwise(F.lower("method")).alias("method"))
    return validate_submissions(rows, [k.upper() for k in KINDS], ["SQL", "ASSISTANT"])
