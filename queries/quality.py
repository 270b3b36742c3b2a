"""Data quality and governance."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import CLEAN, COHORT, INTAKE_RULES, intake_raw, score_log, with_views
from shoreline.functions.labels import tier_points
from shoreline.operators.governance import (metadata_report, set_column_comments, set_table_comment, set_tags,
                                            table_comment, tag_report)
from shoreline.operators.leaderboard import best_scores, event_totals, team_totals
from shoreline.operators.quality import (Rule, apply_rules, artifact_report, domain_report, invalid_code, key_uniqueness,
                                         offending_keys, profile, quality_report, reconcile_layers, rule_metrics)
from shoreline.plans.medallion import build_layers, clean, rollup
from shoreline.session import shared_folder
from shoreline.sinks.tables import overwrite_table
from queries.sinks import fresh_name

NOT_VALID = "value NOT BETWEEN 0 AND 500"


@query("dq_01_drop_rules", with_views("intake_raw", "SELECT * FROM intake_raw WHERE value IS NOT NULL AND value BETWEEN 0 AND 500"))
def drop_rules(spark, sf):
    return apply_rules(intake_raw(spark, sf), INTAKE_RULES)


@query("dq_02_warn_rules", with_views("intake_raw", """
    SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE value IS NULL) AS has_value,
           COUNT(*) FILTER (WHERE value IS NULL OR NOT value BETWEEN 0 AND 500) AS valid_value FROM intake_raw"""))
def warn_rules(spark, sf):
    warned, seen = [Rule(r.name, r.constraint, "warn") for r in INTAKE_RULES], Observation()
    n_rows = apply_rules(intake_raw(spark, sf), warned, seen).count()
    counts = seen.get
    return spark.createDataFrame([(n_rows, counts["has_value"], counts["valid_value"])], "n_rows long, has_value long, valid_value long")


@query("dq_03_rule_metrics", with_views("intake_raw", """
    SELECT 'has_value' AS rule, 'drop' AS action, COUNT(value) AS passed, COUNT(*) - COUNT(value) AS failed FROM intake_raw
    UNION ALL SELECT 'valid_value', 'drop', COUNT(*) FILTER (WHERE value BETWEEN 0 AND 500),
                     COUNT(*) - COUNT(*) FILTER (WHERE value BETWEEN 0 AND 500) FROM intake_raw
    UNION ALL SELECT 'has_event_id', 'warn', COUNT(event_id), COUNT(*) - COUNT(event_id) FROM intake_raw"""))
def metrics(spark, sf):
    return rule_metrics(intake_raw(spark, sf), INTAKE_RULES)


@query("dq_04_quality_report", with_views("intake_raw", f"""
    SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE value IS NULL) AS null_value,
           COUNT(*) FILTER (WHERE {NOT_VALID}) AS invalid_value, COUNT(*) FILTER (WHERE value < 0) AS negative_value,
           COUNT(*) - COUNT(DISTINCT event_id) AS duplicate_events,
           ROUND((COUNT(*) - COUNT(*) FILTER (WHERE value IS NULL OR {NOT_VALID})) * 100.0 / COUNT(*)::DOUBLE, 6) AS clean_pct
    FROM intake_raw"""))
def report(spark, sf):
    value = F.col("value")
    invalid = ~value.between(0, 500)
    return quality_report(intake_raw(spark, sf), "event_id",
                          {"null_value": value.isNull(), "invalid_value": invalid, "negative_value": value < 0},
                          dirty=value.isNull() | invalid, digits=6)


@query("dq_05_profile", with_views("intake_raw", f"""
    SELECT COUNT(*) AS "rows", COUNT(DISTINCT event_id) AS distinct_keys, COUNT(*) FILTER (WHERE value IS NULL) AS null_value,
           COUNT(*) FILTER (WHERE user_id IS NULL) AS null_user_id,
           COUNT(*) FILTER (WHERE value IN (999, -1) OR {NOT_VALID}) AS invalid_value FROM intake_raw"""))
def profiled(spark, sf):
    return profile(intake_raw(spark, sf), "event_id", ["value", "user_id"],
                   {"value": invalid_code(F.col("value"), [999.0, -1.0], 0, 500)})


@query("dq_06_layer_reconciliation", with_views("gold", """
    SELECT r.n AS raw_rows, s.n AS clean_rows, g.n AS rollup_rows, g.groups, g.outcomes, r.n - s.n AS removed_rows,
           ROUND(s.n * 100.0 / NULLIF(r.n, 0)::DOUBLE, 6) AS pass_rate_pct
    FROM (SELECT COUNT(*) AS n FROM intake_raw) r, (SELECT COUNT(*) AS n FROM silver) s,
         (SELECT COUNT(*) AS n, COUNT(DISTINCT value_group) AS groups, COUNT(DISTINCT outcome) AS outcomes FROM gold) g"""))
def reconciliation(spark, sf):
    layers = build_layers(intake_raw(spark, sf), CLEAN, COHORT, shared_folder(spark, "layers"))
    return reconcile_layers(*layers, {"groups": "value_group", "outcomes": "outcome"}, digits=6)


ARTIFACTS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
             "embeddings", "pages", "benchmark", "labels", "conversations"]


@query("dq_07_artifact_report", " UNION ALL ".join(f"""
    SELECT 'report_{t}' AS table_name, COUNT(*) AS "rows",
           CAST((SELECT COUNT(*) FROM (DESCRIBE {t})) AS INT) AS columns,
           CASE WHEN COUNT(*) < 225 THEN 'LOW' ELSE 'OK' END AS status FROM {t}""" for t in ARTIFACTS) + """
    UNION ALL SELECT 'report_absent', 0::BIGINT, 0, 'MISSING'""")
def artifacts(spark, sf):
    for t in ARTIFACTS:
        table(spark, sf, t).createOrReplaceTempView(f"report_{t}")
    return artifact_report(spark, {f"report_{t}": 250 for t in [*ARTIFACTS, "absent"]})


@query("dq_08_domain_check", """
    SELECT COALESCE(d.value, e.value) AS value, COALESCE(d.n, 0) AS "rows",
           CASE WHEN e.value IS NULL THEN 'unexpected' WHEN d.value IS NULL THEN 'missing' ELSE 'ok' END AS status
    FROM (SELECT l_returnflag AS value, COUNT(*) AS n FROM lineitem GROUP BY 1) d
    FULL JOIN (VALUES ('A'), ('R'), ('X')) AS e(value) ON d.value = e.value""")
def domain(spark, sf):
    return domain_report(table(spark, sf, "lineitem"), "l_returnflag", ["A", "R", "X"])


@query("dq_09_threshold_tiers", with_views("totals", """
    SELECT team, total_points, CASE WHEN total_points >= 2200 THEN 15 WHEN total_points >= 1900 THEN 12
           WHEN total_points >= 1700 THEN 10 WHEN total_points >= 1500 THEN 7 ELSE 4 END AS tier_points FROM totals"""))
def tiers(spark, sf):
    totals = team_totals(event_totals(best_scores(score_log(spark, sf))), 6)
    points = tier_points(F.col("total_points"), [(2200, 15), (1900, 12), (1700, 10), (1500, 7)], otherwise=4)
    return totals.select("team", "total_points", points.alias("tier_points"))


@query("dq_10_key_uniqueness", with_views("silver", """
    SELECT 'raw' AS layer, COUNT(*) AS "rows", COUNT(DISTINCT event_id) AS distinct_keys, COUNT(*) - COUNT(DISTINCT event_id) AS surplus_rows,
           COUNT(*) = COUNT(DISTINCT event_id) AS is_unique FROM intake_raw
    UNION ALL SELECT 'clean', COUNT(*), COUNT(DISTINCT event_id), COUNT(*) - COUNT(DISTINCT event_id),
           COUNT(*) = COUNT(DISTINCT event_id) FROM silver"""))
def uniqueness(spark, sf):
    raw = intake_raw(spark, sf)
    return (key_uniqueness(raw, "event_id").withColumn("layer", F.lit("raw"))
            .unionByName(key_uniqueness(clean(raw, CLEAN), "event_id").withColumn("layer", F.lit("clean"))))


@query("dq_10_offending_keys", with_views("intake_raw", """
    SELECT event_id, COUNT(*) AS "rows" FROM intake_raw GROUP BY event_id HAVING COUNT(*) > 1"""))
def offending(spark, sf):
    return offending_keys(intake_raw(spark, sf), ["event_id"])


def described_tables(spark, sf):
    """Silver and Gold stored as catalog tables with comments and tags."""
    names = []
    cleaned = clean(intake_raw(spark, sf), CLEAN)
    for stem, df in (("silver", cleaned), ("gold", rollup(cleaned, COHORT))):
        path = shared_folder(spark, stem)
        name = fresh_name(stem, path)
        overwrite_table(df, name, path)
        names.append(name)
    silver, gold = names
    set_table_comment(spark, silver, "Cleaned events: validated values, one row per event_id")
    set_table_comment(spark, gold, "Event metrics by value group, for the dashboards' tiles")
    skipped = set_column_comments(spark, {silver: {
        "event_id": "Unique event identifier", "value": "Measured value (validated 0-500)", "absent": "no such column"}})
    set_tags(spark, silver, {"layer": "silver", "domain": "events", "rows": str(spark.table(silver).count())})
    set_tags(spark, gold, {"layer": "gold", "rows": str(spark.table(gold).count())})
    return silver, gold, skipped


@query("gov_01_table_comments", with_views("gold", """
    SELECT 'silver' AS layer, 'Cleaned events: validated values, one row per event_id' AS comment, (SELECT COUNT(*) FROM silver) AS n_rows
    UNION ALL SELECT 'gold', 'Event metrics by value group, for the dashboards'' tiles', (SELECT COUNT(*) FROM gold)"""))
def comments(spark, sf):
    silver, gold, _ = described_tables(spark, sf)
    lines = [spark.table(t).agg(F.count("*").alias("n_rows")).select(
        F.lit(layer).alias("layer"), F.lit(table_comment(spark, t)).alias("comment"), "n_rows")
        for layer, t in (("silver", silver), ("gold", gold))]
    return lines[0].unionByName(lines[1])


@query("gov_02_column_comments", with_views("silver", """
    SELECT 1 AS skipped, 2 AS commented, COUNT(*) AS n_rows FROM silver"""))
def column_comments(spark, sf):
    silver, _, skipped = described_tables(spark, sf)
    commented = sum(1 for c in spark.catalog.listColumns(silver) if c.description)
    return spark.table(silver).agg(F.count("*").alias("n_rows")).select(
        F.lit(len(skipped)).alias("skipped"), F.lit(commented).alias("commented"), "n_rows")


@query("gov_03_tags", with_views("gold", """
    SELECT 'silver' AS layer, 'layer' AS tag, 'silver' AS value UNION ALL SELECT 'silver', 'domain', 'events'
    UNION ALL SELECT 'silver', 'rows', COUNT(*)::VARCHAR FROM silver
    UNION ALL SELECT 'gold', 'layer', 'gold' UNION ALL SELECT 'gold', 'rows', COUNT(*)::VARCHAR FROM gold"""))
def tags(spark, sf):
    silver, gold, _ = described_tables(spark, sf)
    layer = F.when(F.col("table_name") == silver, "silver").otherwise("gold")
    return tag_report(spark, [silver, gold]).select(layer.alias("layer"), "tag", "value")


@query("gov_04_metadata_coverage", with_views("gold", """
    SELECT 'silver' AS layer, TRUE AS has_comment, 5 AS columns, 2 AS commented_columns,
           COUNT(event_id) + COUNT(ts) + COUNT(user_id) + COUNT(event_type) + COUNT(value) AS filled_cells FROM silver
    UNION ALL SELECT 'gold', TRUE, 5, 0, COUNT(value_group) + COUNT(outcome) + COUNT(event_count) + COUNT(avg_value) + COUNT(avg_user) FROM gold"""))
def coverage(spark, sf):
    silver, gold, _ = described_tables(spark, sf)
    layer = F.when(F.col("table_name") == silver, "silver").otherwise("gold")
    lines = [spark.table(t).agg(sum((F.count(c) for c in spark.table(t).columns), F.lit(0)).alias("filled_cells")).withColumn("table_name", F.lit(t))
             for t in (silver, gold)]
    return metadata_report(spark, [silver, gold]).join(lines[0].unionByName(lines[1]), "table_name").select(
        layer.alias("layer"), "has_comment", "columns", "commented_columns", "filled_cells")
