"""Window functions."""

from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import CLEAN, answer_key, intake_raw, registered, score_log, submissions, with_views
from shoreline.operators.cohort import share_of_total
from shoreline.operators.dedup import keep_latest
from shoreline.operators.leaderboard import behind_leader, leaderboard, standings
from shoreline.operators.ranking import change_from_previous, dense_rank_within
from shoreline.operators.scoring import check_answers, first_correct
from shoreline.plans.medallion import CleanSpec, RULES_FIRST, clean

BOARD = """SELECT r.team, COALESCE(t.total_points, 0) AS total_points FROM registered r LEFT JOIN totals t ON r.team = t.team"""
MONTHLY = """SELECT o_orderpriority, STRFTIME(o_orderdate, '%Y-%m') AS month, ROUND(SUM(o_totalprice), 2) AS total
             FROM orders GROUP BY 1, 2"""


@query("win_01_dedup_earliest", with_views("silver", "SELECT * FROM silver"))
def dedup_earliest(spark, sf):
    return clean(intake_raw(spark, sf), CLEAN)


@query("win_01_rules_then_dedup", with_views("intake_raw", """
    SELECT event_id, ts, user_id, event_type, value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts) AS rn FROM intake_raw
        WHERE value IS NOT NULL AND value BETWEEN 0 AND 500) WHERE rn = 1"""))
def rules_then_dedup(spark, sf):
    return clean(intake_raw(spark, sf), CleanSpec(CLEAN.key, CLEAN.time, CLEAN.rules, CLEAN.tie_break, RULES_FIRST))


@query("win_02_latest_per_key", """
    SELECT user_id, event_type, event_id, ts, value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1""")
def latest(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return keep_latest(events, ["user_id", "event_type"], "ts", ["event_id"])


@query("win_03_share_of_total", """
    SELECT l_returnflag, COUNT(*) AS "rows", ROUND(COUNT(*) * 100.0 / (SUM(COUNT(*)) OVER ())::DOUBLE, 6) AS share_pct
    FROM lineitem GROUP BY l_returnflag""")
def share(spark, sf):
    return share_of_total(table(spark, sf, "lineitem"), ["l_returnflag"], digits=6)


@query("win_04_global_rank", with_views("totals registered", f"""
    SELECT team, total_points, ROW_NUMBER() OVER (ORDER BY total_points DESC, team) AS rank FROM ({BOARD})"""))
def rank(spark, sf):
    return leaderboard(score_log(spark, sf), registered(spark, sf), 6).select("team", "total_points", "rank")


@query("win_05_gap_to_leader", with_views("totals registered", f"""
    SELECT team, ROUND(total_points - FIRST_VALUE(total_points) OVER (ORDER BY total_points DESC, team), 6) AS gap FROM ({BOARD})"""))
def gap(spark, sf):
    board = leaderboard(score_log(spark, sf), registered(spark, sf), 6)
    return board.select("team", F.round("gap_to_leader", 6).alias("gap"))


@query("win_05_behind_leader", with_views("totals registered", f"""
    WITH board AS ({BOARD}) SELECT team, total_points, ROUND(total_points - (SELECT MAX(total_points) FROM board), 6) AS gap
    FROM board WHERE total_points < (SELECT MAX(total_points) FROM board)"""))
def behind(spark, sf):
    board = standings(score_log(spark, sf), registered(spark, sf), 6)
    return behind_leader(board).select("team", "total_points", F.round("gap", 6).alias("gap"))


def monthly(spark, sf):
    return table(spark, sf, "orders").groupBy(
        "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("win_06_lag_change", f"""
    SELECT o_orderpriority, month, total, LAG(total) OVER w AS previous, ROUND(total - LAG(total) OVER w, 2) AS change
    FROM ({MONTHLY}) WINDOW w AS (PARTITION BY o_orderpriority ORDER BY month)""")
def lag_change(spark, sf):
    return change_from_previous(monthly(spark, sf), ["o_orderpriority"], "month", "total").withColumn(
        "change", F.round("change", 2))


@query("win_07_dense_rank", f"""
    SELECT o_orderpriority, month, total, CAST(DENSE_RANK() OVER (PARTITION BY month ORDER BY total DESC) AS INT) AS rank
    FROM ({MONTHLY})""")
def dense(spark, sf):
    return dense_rank_within(monthly(spark, sf), ["month"], "total")


@query("win_08_first_correct", with_views("submissions", """
    SELECT question_id, team, submitted_at, 1 AS bonus FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY question_id ORDER BY submitted_at, team) AS rn FROM submissions
        WHERE event_id % 6 IN (0, 1, 2)) WHERE rn = 1"""))
def first_right(spark, sf):
    key = answer_key(spark, sf)
    return first_correct(check_answers(submissions(spark, sf, key), key))


@query("win_09_medals", with_views("totals registered", f"""
    SELECT team, rank, CASE rank WHEN 1 THEN 'gold' WHEN 2 THEN 'silver' WHEN 3 THEN 'bronze' END AS medal
    FROM (SELECT team, ROW_NUMBER() OVER (ORDER BY total_points DESC, team) AS rank FROM ({BOARD}))"""))
def medals(spark, sf):
    return leaderboard(score_log(spark, sf), registered(spark, sf), 6).select("team", "rank", "medal")
