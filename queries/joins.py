"""Joins."""

from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import CLEAN, answer_key, intake_raw, registered, score_log, submissions, with_views
from shoreline.operators.joins import absent_keys, feature_lookup, grid, left_with_defaults, with_scalars
from shoreline.operators.leaderboard import best_scores, completion_rate, event_dimension, event_totals, team_totals
from shoreline.operators.ranking import gap_to_leader
from shoreline.operators.scoring import check_answers, latest_answers
from shoreline.plans.medallion import clean


@query("jn_01_left_default", with_views("totals registered", """
    SELECT r.team, COALESCE(t.total_points, 0) AS total_points FROM registered r LEFT JOIN totals t ON r.team = t.team"""))
def left_default(spark, sf):
    totals = team_totals(event_totals(best_scores(score_log(spark, sf))), 6).select("team", "total_points")
    return left_with_defaults(registered(spark, sf), totals, ["team"], {"total_points": 0.0})


@query("jn_02_chained_left", with_views("totals registered", """
    SELECT r.team, t.total_points, l.last_scored, f.first_scored
    FROM registered r LEFT JOIN totals t ON r.team = t.team
    LEFT JOIN (SELECT team, MAX(scored_at) AS last_scored FROM score_log GROUP BY team) l ON r.team = l.team
    LEFT JOIN (SELECT team, MIN(scored_at) AS first_scored FROM score_log GROUP BY team) f ON r.team = f.team"""))
def chained_left(spark, sf):
    by_event = event_totals(best_scores(score_log(spark, sf)))
    totals = team_totals(by_event, 6).select("team", "total_points", "last_scored")
    first = by_event.groupBy("team").agg(F.min("first_scored").alias("first_scored"))
    return registered(spark, sf).join(totals, "team", "left").join(first, "team", "left")


@query("jn_03_grid", with_views("best registered", """
    SELECT r.team, e.event, COALESCE(b.points, 0) AS points
    FROM registered r CROSS JOIN (SELECT DISTINCT event FROM score_log) e
    LEFT JOIN (SELECT team, event, ROUND(SUM(points), 6) AS points FROM best GROUP BY team, event) b
           ON r.team = b.team AND e.event = b.event"""))
def dense_grid(spark, sf):
    log = score_log(spark, sf)
    cells = grid(registered(spark, sf), event_dimension(log), "event")
    points = event_totals(best_scores(log)).select("team", "event", F.round("points", 6).alias("points"))
    return left_with_defaults(cells, points, ["team", "event"], {"points": 0.0})


@query("jn_04_join_condition", with_views("best registered", """
    WITH by_event AS (SELECT team, event, ROUND(SUM(points), 6) AS points FROM best GROUP BY team, event),
         events_all AS (SELECT DISTINCT event FROM score_log UNION ALL SELECT 'refund')
    SELECT e.event, COUNT(DISTINCT b.team) AS teams_submitted, (SELECT COUNT(DISTINCT team) FROM registered) AS total_teams,
           ROUND(COUNT(DISTINCT b.team) * 100.0 / (SELECT COUNT(DISTINCT team) FROM registered)::DOUBLE, 6) AS completion_pct
    FROM events_all e LEFT JOIN by_event b ON b.event = e.event AND b.points > 0 GROUP BY e.event"""))
def join_condition(spark, sf):
    log = score_log(spark, sf)
    configured = spark.createDataFrame([("refund",)], "event string")
    return completion_rate(log, registered(spark, sf), event_dimension(log, configured), digits=6)


@query("jn_05_one_row_join", with_views("totals", """
    SELECT team, total_points, ROUND(total_points - (SELECT MAX(total_points) FROM totals), 6) AS gap FROM totals"""))
def one_row_join(spark, sf):
    totals = team_totals(event_totals(best_scores(score_log(spark, sf))), 6).select("team", "total_points")
    return gap_to_leader(totals, "total_points", "gap").withColumn("gap", F.round("gap", 6))


@query("jn_06_scalar_subqueries", with_views("silver", """
    SELECT (SELECT COUNT(*) FROM intake_raw) AS raw_rows, (SELECT COUNT(*) FROM silver) AS clean_rows,
           (SELECT COUNT(DISTINCT event_type) FROM silver) AS event_types"""))
def scalar_subqueries(spark, sf):
    raw = intake_raw(spark, sf)
    cleaned = clean(raw, CLEAN)
    return with_scalars(raw.agg(F.count("*").alias("raw_rows")), (
        cleaned, {"clean_rows": F.count("*"), "event_types": F.count_distinct("event_type")}))


@query("jn_07_absent_keys", """
    SELECT c_custkey, c_mktsegment FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""")
def anti(spark, sf):
    users = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    return absent_keys(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), users, ["c_custkey"])


@query("jn_08_answer_key_lookup", with_views("submissions", """
    SELECT s.team, s.question_id, s.answer, k.answer AS expected FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY team, question_id ORDER BY submitted_at DESC, event_id DESC) AS rn
        FROM submissions) s JOIN answer_key k ON s.question_id = k.question_id WHERE rn = 1"""))
def key_lookup(spark, sf):
    key = answer_key(spark, sf)
    latest = latest_answers(submissions(spark, sf, key), tie_break=["event_id"])
    return check_answers(latest, key).select("team", "question_id", "answer", "expected")


@query("jn_09_feature_lookup", """
    SELECT l.doc_id, l.quality, d.lang, d.n_chars, LENGTH(d.text) - LENGTH(REPLACE(d.text, ' ', '')) AS blanks
    FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
def lookup(spark, sf):
    text = F.col("text")
    features = table(spark, sf, "documents").select(
        "doc_id", "lang", "n_chars",
        (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long").alias("blanks"))
    return feature_lookup(table(spark, sf, "labels").select("doc_id", "quality"), features, ["doc_id"])
