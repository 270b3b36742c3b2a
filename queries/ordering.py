"""Sorting, top-k, samples, set operations."""

from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import score_log, with_views
from shoreline.functions.numbers import mean
from shoreline.functions.text import truncated
from shoreline.operators.leaderboard import score_history
from shoreline.operators.quality import column_report
from shoreline.operators.ranking import fixed_size_sample, top_k


@query("ord_01_multi_key_sort", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part ORDER BY p_brand, p_size DESC, p_partkey")
def multi_key_sort(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice").orderBy(
        F.asc("p_brand"), F.desc("p_size"), F.asc("p_partkey"))


@query("ord_02_top_k", """
    SELECT p_brand, SUM(CAST(ROUND(p_retailprice * 100) AS BIGINT))::DOUBLE / 100 / COUNT(*) AS avg_price, COUNT(*) AS n_rows FROM part GROUP BY p_brand
    ORDER BY 2 DESC, 1 LIMIT 5""")
def top_brands(spark, sf):
    brands = table(spark, sf, "part").groupBy("p_brand").agg(
        mean(F.col("p_retailprice"), None, scale=2).alias("avg_price"), F.count("*").alias("n_rows"))
    return top_k(brands, [F.desc("avg_price"), F.asc("p_brand")], 5)


@query("ord_03_recent_history", with_views("score_log", """
    SELECT team, event, category, points, max_points, scored_at, event_id FROM score_log
    ORDER BY scored_at DESC, event_id DESC LIMIT 200"""))
def recent(spark, sf):
    return score_history(score_log(spark, sf), 200, ("event_id",))


@query("ord_04_preview", "SELECT doc_id, lang, LEFT(text, 80) AS preview FROM documents ORDER BY doc_id LIMIT 5")
def preview(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", truncated(F.col("text"), 80).alias("preview"))
    return top_k(docs, ["doc_id"], 5)


@query("ord_05_seeded_sample", "SELECT 50::BIGINT AS n_rows, 50::BIGINT AS distinct_keys, 50::BIGINT AS in_the_table")
def sample(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem")
    taken = fixed_size_sample(lines, keys, 50).select(*keys)
    found = taken.join(lines.select(*keys, F.lit(1).alias("there")).distinct(), keys, "left")
    return found.agg(F.count("*").alias("n_rows"), F.count_distinct(*keys).alias("distinct_keys"), F.count("there").alias("in_the_table"))


@query("set_01_union_all", """
    SELECT s_nationkey AS nation, 'supplier' AS kind FROM supplier UNION ALL SELECT c_nationkey, 'customer' FROM customer""")
def union_all(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind"))
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.lit("customer").alias("kind"))
    return suppliers.unionByName(customers)


@query("set_02_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def distinct(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type").distinct()


@query("set_03_column_report", """
    SELECT 'customer' AS table_name, (SELECT COUNT(*) FROM customer) AS "rows", 1 AS missing_count, 'c_phone' AS missing, 'TOLERATED' AS verdict
    UNION ALL SELECT 'orders', (SELECT COUNT(*) FROM orders), 0, '', 'OK'
    UNION ALL SELECT 'part', (SELECT COUNT(*) FROM part), 3, 'p_comment, p_container, p_mfgr', 'FAILED'""")
def columns(spark, sf):
    expected = {"customer": ["c_custkey", "c_name", "c_phone"], "orders": ["o_orderkey", "o_custkey"],
                "part": ["p_partkey", "p_mfgr", "p_container", "p_comment"]}
    return column_report({t: table(spark, sf, t) for t in expected}, expected)
