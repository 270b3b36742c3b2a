"""Aggregations."""

from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import CLEAN, COHORT, cohort_base, intake_raw, score_log, with_views
from shoreline.functions.labels import bucketize, flag_label
from shoreline.operators.cohort import (chi_squared, class_balance, cohort_table, compare_metrics, describe,
                                        distinct_joined, rate_by, top_value)
from shoreline.operators.leaderboard import best_scores, event_totals, team_totals
from shoreline.plans.medallion import clean, rollup
from shoreline.sources.tables import rows_per_table

QUANTITY_CASE = """CASE WHEN l_quantity < 10 THEN 'under 10' WHEN l_quantity < 20 THEN '10-19'
                        WHEN l_quantity < 30 THEN '20-29' ELSE '30+' END"""


def quantity_group():
    return bucketize(F.col("l_quantity"), [10, 20, 30], ["under 10", "10-19", "20-29", "30+"])


@query("agg_00_flagship_gold", with_views("gold", "SELECT * FROM gold"))
def flagship_gold(spark, sf):
    return rollup(clean(intake_raw(spark, sf), CLEAN), COHORT)


@query("agg_01_filtered_count", """
    SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS returned FROM lineitem""")
def filtered_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count("*").alias("n_rows"),
                                            F.count_if(F.col("l_returnflag") == "R").alias("returned"))


@query("agg_02_cohort_gold", with_views("cohort_base", f"""
    SELECT {QUANTITY_CASE} AS quantity_group, CASE WHEN flag = 1 THEN 'Returned' ELSE 'Kept' END AS outcome,
           COUNT(*) AS row_count, ROUND(AVG(l_extendedprice), 6) AS avg_price, ROUND(AVG(l_discount), 6) AS avg_discount,
           ROUND(AVG(l_tax), 6) AS avg_tax FROM cohort_base GROUP BY 1, 2"""))
def cohort_gold(spark, sf):
    return cohort_table(
        cohort_base(spark, sf),
        {"quantity_group": quantity_group(), "outcome": flag_label(F.col("flag") == 1, "Returned", "Kept")},
        {"avg_price": "l_extendedprice", "avg_discount": "l_discount", "avg_tax": "l_tax"}, digits=6)


@query("agg_03_rate_by_group", with_views("cohort_base", f"""
    SELECT {QUANTITY_CASE} AS quantity_group, COUNT(*) AS total, CAST(SUM(flag) AS BIGINT) AS hits,
           ROUND(SUM(flag) * 100.0 / COUNT(*)::DOUBLE, 6) AS rate_pct FROM cohort_base GROUP BY 1"""))
def rate(spark, sf):
    return rate_by(cohort_base(spark, sf), {"quantity_group": quantity_group()}, F.col("flag") == 1, digits=6)


@query("agg_04_distinct_counts", """
    SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS parts, COUNT(*) AS n_rows FROM lineitem GROUP BY l_returnflag""")
def distinct_counts(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count("*").alias("n_rows"))


@query("agg_05_min_max", """
    SELECT o_orderpriority, MIN(o_totalprice) AS min_price, MAX(o_totalprice) AS max_price, MIN(o_orderdate) AS first_order,
           MAX(STRFTIME(o_orderdate, '%Y-%m-%d')) AS last_day FROM orders GROUP BY o_orderpriority""")
def min_max(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"),
        F.min("o_orderdate").alias("first_order"),
        F.max(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("last_day"))


@query("agg_06_label_after_group", with_views("cohort_base", """
    SELECT CASE WHEN flag = 1 THEN 'Returned' ELSE 'Kept' END AS outcome, ROUND(AVG(l_quantity), 6) AS avg_quantity
    FROM cohort_base GROUP BY flag"""))
def label_after_group(spark, sf):
    averages = cohort_base(spark, sf).groupBy("flag").agg(F.round(F.avg("l_quantity"), 6).alias("avg_quantity"))
    return averages.select(flag_label(F.col("flag") == 1, "Returned", "Kept").alias("outcome"), "avg_quantity")


@query("agg_07_group_by_ordinal", """
    SELECT lang, source, COUNT(*) AS n_docs, CAST(SUM(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1, 2""")
def group_by_ordinal(spark, sf):
    return spark.sql("""SELECT lang, source, COUNT(*) AS n_docs, SUM(n_chars) AS chars FROM {documents} GROUP BY 1, 2""",
                     documents=table(spark, sf, "documents"))


@query("agg_08_distinct_joined", """
    SELECT lang, CAST(SUM(n) AS BIGINT) AS "rows", COUNT(source) AS distinct_values, STRING_AGG(source, ', ' ORDER BY source) AS joined
    FROM (SELECT lang, source, COUNT(*) AS n FROM documents GROUP BY lang, source) GROUP BY lang""")
def joined_sets(spark, sf):
    return distinct_joined(table(spark, sf, "documents"), ["lang"], "source")


@query("agg_09_top_value", """
    SELECT o_orderpriority, COUNT(*) AS "rows" FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def most_common(spark, sf):
    return top_value(table(spark, sf, "orders"), "o_orderpriority")


@query("agg_09_top_value_per_group", """
    SELECT event_type, user_id, n AS "rows" FROM (
        SELECT event_type, user_id, COUNT(*) AS n,
               ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY COUNT(*) DESC, user_id) AS rn
        FROM events GROUP BY event_type, user_id) WHERE rn = 1""")
def most_common_per_group(spark, sf):
    return top_value(table(spark, sf, "events"), "user_id", ["event_type"])


METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("agg_10_metric_comparison", with_views("cohort_base", " UNION ALL ".join(f"""
    SELECT '{m}' AS metric, ROUND(AVG(CASE WHEN flag = 1 THEN {m} END), 6) AS returned_avg,
           ROUND(AVG(CASE WHEN flag = 0 THEN {m} END), 6) AS kept_avg,
           ROUND((AVG(CASE WHEN flag = 1 THEN {m} END) - AVG(CASE WHEN flag = 0 THEN {m} END))
                 / AVG(CASE WHEN flag = 0 THEN {m} END) * 100, 6) AS pct_diff FROM cohort_base""" for m in METRICS)))
def metric_comparison(spark, sf):
    return compare_metrics(cohort_base(spark, sf), F.col("flag") == 1, METRICS, ("returned_avg", "kept_avg"), digits=6)


@query("agg_11_wide_comparison", with_views("cohort_base", """
    SELECT flag, COUNT(*) AS row_count, ROUND(AVG(l_quantity), 6) AS avg_quantity, ROUND(AVG(l_extendedprice), 6) AS avg_price,
           ROUND(AVG(l_discount), 6) AS avg_discount, ROUND(AVG(l_tax), 6) AS avg_tax, ROUND(AVG(code), 6) AS avg_code
    FROM cohort_base GROUP BY flag"""))
def wide_comparison(spark, sf):
    return cohort_table(cohort_base(spark, sf), {"flag": F.col("flag")},
                        {"avg_quantity": "l_quantity", "avg_price": "l_extendedprice", "avg_discount": "l_discount",
                         "avg_tax": "l_tax", "avg_code": "code"}, digits=6)


@query("agg_12_chi_squared", """
    WITH cells AS (SELECT l_returnflag AS r, l_linestatus AS c, COUNT(*)::DOUBLE AS o FROM lineitem GROUP BY 1, 2),
         rt AS (SELECT r, SUM(o) AS t FROM cells GROUP BY r), ct AS (SELECT c, SUM(o) AS t FROM cells GROUP BY c),
         expected AS (SELECT rt.r, ct.c, rt.t * ct.t / (SELECT SUM(o) FROM cells) AS e FROM rt CROSS JOIN ct),
         chi AS (SELECT SUM((COALESCE(o, 0) - e) * (COALESCE(o, 0) - e) / e) AS x
                 FROM expected LEFT JOIN cells USING (r, c))
    SELECT ROUND(x, 6) AS chi2_statistic, ROUND(EXP(-x / 2), 6) AS p_value,
           CAST(((SELECT COUNT(*) FROM rt) - 1) * ((SELECT COUNT(*) FROM ct) - 1) AS INT) AS degrees_of_freedom,
           EXP(-x / 2) < 0.05 AS is_significant FROM chi""")
def independence_test(spark, sf):
    return chi_squared(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus").select(
        F.round("chi2_statistic", 6).alias("chi2_statistic"), F.round("p_value", 6).alias("p_value"),
        "degrees_of_freedom", "is_significant")


@query("agg_13_best_scores", with_views("score_log", """
    SELECT team, event, category, MAX(points) AS points, MAX(max_points) AS max_points, MIN(scored_at) AS first_scored,
           MAX(scored_at) AS last_scored FROM score_log GROUP BY team, event, category"""))
def best(spark, sf):
    return best_scores(score_log(spark, sf))


@query("agg_14_two_level_rollup", with_views("totals", "SELECT team, total_points, events_done FROM totals"))
def two_level(spark, sf):
    return team_totals(event_totals(best_scores(score_log(spark, sf))), 6).select("team", "total_points", "events_done")


@query("agg_15_kpi_row", """
    SELECT COUNT(*) AS n_rows, COUNT(DISTINCT user_id) AS users, ROUND(AVG(value), 6) AS avg_value,
           MIN(ts) AS first_ts, MAX(ts) AS last_ts, COUNT(*) FILTER (WHERE event_type = 'error') AS errors FROM events""")
def kpi_row(spark, sf):
    return table(spark, sf, "events").agg(
        F.count("*").alias("n_rows"), F.count_distinct("user_id").alias("users"),
        F.round(F.avg("value"), 6).alias("avg_value"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.count_if(F.col("event_type") == "error").alias("errors"))


SOURCES = ["events", "lineitem", "orders", "customer", "documents"]


@query("agg_16_rows_per_source", " UNION ALL ".join(
    f"""SELECT '{t}' AS source, COUNT(*) AS "rows" FROM {t}""" for t in SOURCES))
def rows_per_source(spark, sf):
    return rows_per_table({t: table(spark, sf, t) for t in SOURCES})


@query("agg_17_describe", " UNION ALL ".join(f"""
    SELECT '{m}' AS column_name, COUNT({m}) AS row_count, ROUND(AVG({m}), 6) AS mean, ROUND(STDDEV_SAMP({m}), 6) AS std,
           MIN({m}) AS min, MAX({m}) AS max FROM lineitem""" for m in METRICS))
def described(spark, sf):
    return describe(table(spark, sf, "lineitem"), METRICS, digits=6)


@query("agg_17_class_balance", """
    SELECT quality, COUNT(*) AS "rows", ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM labels)::DOUBLE, 6) AS share_pct
    FROM labels GROUP BY quality""")
def balance(spark, sf):
    return class_balance(table(spark, sf, "labels"), "quality", digits=6)
