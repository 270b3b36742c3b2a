"""Leaderboard reports over an append-only score log.

The log is read once: the best score per (team, event, category) carries the first and
last time along, so totals, event points and times all come from that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.functions.numbers import percent
from shoreline.operators.joins import grid, left_with_defaults
from shoreline.operators.ranking import gap_to_leader, global_rank, medal, top_k
from shoreline.session import checkpoint_root

DONE, OPEN = "Submitted", "Not Started"


def best_scores(log: DataFrame) -> DataFrame:
    """Best points per team, event and category, with the first and last time scored."""
    return log.groupBy("team", "event", "category").agg(
        F.max("points").alias("points"), F.max("max_points").alias("max_points"),
        F.min("scored_at").alias("first_scored"), F.max("scored_at").alias("last_scored"))


def event_totals(best: DataFrame) -> DataFrame:
    """Best scores summed per team and event."""
    return best.groupBy("team", "event").agg(
        F.sum("points").alias("points"), F.sum("max_points").alias("max_points"),
        F.min("first_scored").alias("first_scored"), F.max("last_scored").alias("last_scored"))


def team_totals(by_event: DataFrame, digits: int = 1) -> DataFrame:
    """Event totals summed per team."""
    return by_event.groupBy("team").agg(
        F.round(F.sum("points"), digits).alias("total_points"),
        F.count("event").alias("events_done"), F.max("last_scored").alias("last_scored"))


def max_possible(best: DataFrame) -> DataFrame:
    """One row: the points a team can reach, summed over the log's events and categories."""
    return (best.groupBy("event", "category").agg(F.max("max_points").alias("max_points"))
            .agg(F.sum("max_points").alias("max_possible")))


def standings(log: DataFrame, teams: DataFrame, digits: int = 1) -> DataFrame:
    """Every registered team with its total (0 if none), share of the maximum and last time.

    The best scores are checkpointed, since totals and maximum would each read the log.
    """
    checkpoint_root(log.sparkSession)
    best = best_scores(log).checkpoint()
    totals = team_totals(event_totals(best), digits)
    board = left_with_defaults(teams.select("team").distinct(), totals, ["team"],
                               {"total_points": 0.0, "events_done": 0})
    limit = max_possible(best).scalar()
    return (board.withColumn("max_possible", limit)
            .withColumn("pct", percent(F.col("total_points"), F.col("max_possible"), digits)))


def leaderboard(log: DataFrame, teams: DataFrame, digits: int = 1) -> DataFrame:
    """Standings with rank, medal and gap to the leader; equal points rank by team."""
    ranked = global_rank(standings(log, teams, digits), [F.desc("total_points"), F.asc("team")])
    return gap_to_leader(ranked, "total_points").withColumn("medal", medal(F.col("rank")))


def behind_leader(board: DataFrame, points: str = "total_points") -> DataFrame:
    """Only the teams strictly below the leader, with their gap."""
    return gap_to_leader(board, points, "gap").filter(F.col("gap") < 0)


def event_dimension(log: DataFrame, configured: DataFrame | None = None) -> DataFrame:
    """Configured events plus the events seen in the log."""
    seen = log.select("event").distinct()
    return seen if configured is None else configured.select("event").union(seen).distinct()


def completion_grid(log: DataFrame, teams: DataFrame, events: DataFrame, digits: int = 1) -> DataFrame:
    """Each team beside each event: points, status and first time."""
    done = event_totals(best_scores(log)).select(
        "team", "event", F.round("points", digits).alias("points"),
        F.col("first_scored").alias("submitted_at"))
    cells = grid(teams.select("team").distinct(), events, "event")
    joined = cells.join(done, ["team", "event"], "left")
    status = F.when(F.col("points") > 0, DONE).otherwise(OPEN)
    return joined.withColumn("status", status).withColumn("points", F.coalesce("points", F.lit(0.0)))


def completion_rate(log: DataFrame, teams: DataFrame, events: DataFrame, digits: int = 0) -> DataFrame:
    """Share of teams with points per event; events without any stay, at 0.

    The condition on points belongs to the join, not to a filter after it. Counting the
    teams per event before the join says the same and joins one row per event.
    """
    scored = (event_totals(best_scores(log)).filter(F.col("points") > 0)
              .groupBy("event").agg(F.count("team").alias("teams_submitted")))
    rows = left_with_defaults(events.select("event").distinct(), scored, ["event"], {"teams_submitted": 0})
    teams_in_all = teams.agg(F.count_distinct("team")).scalar()
    return (rows.withColumn("total_teams", teams_in_all)
            .withColumn("completion_pct", percent(F.col("teams_submitted"), F.col("total_teams"), digits)))


def score_history(log: DataFrame, k: int = 200, tie_break: tuple[str, ...] = ("team",)) -> DataFrame:
    """The newest k entries."""
    return top_k(log, [F.desc("scored_at"), *[F.desc(c) for c in tie_break]], k)


def kpi_tiles(log: DataFrame, teams: DataFrame, digits: int = 1) -> DataFrame:
    """One row: teams, points awarded, events scored, last submission."""
    return (event_totals(best_scores(log))
            .agg(F.round(F.coalesce(F.sum("points"), F.lit(0.0)), digits).alias("points_awarded"),
                 F.count_distinct("event").alias("events_scored"),
                 F.max("last_scored").alias("last_submission"))
            .withColumn("total_teams", teams.agg(F.count_distinct("team")).scalar()))


def timeline(log: DataFrame, unit: str = "MINUTE", time: str = "scored_at") -> DataFrame:
    """Entries per time unit."""
    return log.groupBy(F.date_trunc(unit, time).alias("bucket")).agg(F.count("*").alias("entries"))
