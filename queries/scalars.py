"""Scalar functions."""

from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import score_log, submissions, with_views
from queries.aggregates import QUANTITY_CASE, quantity_group
from shoreline.functions.labels import tier_points
from shoreline.functions.numbers import percent
from shoreline.functions.text import (assemble, assemble_or_blank, contains_any, has_digit, normalize, numeric_tokens,
                                      starts_with_any, truncated)
from shoreline.ml.features import both_over, over, per_plus_one, reserve
from shoreline.operators.leaderboard import timeline
from shoreline.operators.reshape import flatten_result


@query("sca_01_text_assembly", """
    SELECT o_orderkey, 'Order ' || o_orderkey || ': ' || o_orderstatus || ', ' || NULLIF(o_orderpriority, '5-LOW') AS strict_text,
           CONCAT('Order ', o_orderkey, ': ', o_orderstatus, ', ', NULLIF(o_orderpriority, '5-LOW')) AS loose_text FROM orders""")
def text_assembly(spark, sf):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    parts = ["Order ", F.col("o_orderkey"), ": ", F.col("o_orderstatus"), ", ", priority]
    return table(spark, sf, "orders").select("o_orderkey", assemble(*parts).alias("strict_text"),
                                             assemble_or_blank(*parts).alias("loose_text"))


@query("sca_02_round", """
    SELECT l_returnflag, ROUND(AVG(l_quantity), 2) AS two, ROUND(AVG(l_extendedprice), 1) AS one,
           ROUND(AVG(l_extendedprice), 0) AS zero FROM lineitem GROUP BY l_returnflag""")
def rounding(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.avg("l_quantity"), 2).alias("two"), F.round(F.avg("l_extendedprice"), 1).alias("one"),
        F.round(F.avg("l_extendedprice"), 0).alias("zero"))


@query("sca_03_safe_divide", """
    SELECT l_orderkey, l_linenumber, COALESCE(ROUND(l_tax * 100.0 / NULLIF(l_discount, 0), 6), 0) AS tax_per_discount_pct FROM lineitem""")
def safe_divide(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.coalesce(percent(F.col("l_tax"), F.col("l_discount"), 6), F.lit(0.0)).alias("tax_per_discount_pct"))


@query("sca_04_casts", r"""
    SELECT event_id, CAST(FLOOR(value) AS INT) AS whole, CAST(event_id AS VARCHAR) AS id_text,
           TRY_CAST(REGEXP_EXTRACT(props, '[0-9]+') AS DOUBLE) AS k, TRY_CAST(event_type AS INT) AS bad FROM events""")
def casts(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.floor("value").cast("int").alias("whole"), F.col("event_id").cast("string").alias("id_text"),
        F.regexp_extract("props", "[0-9]+", 0).try_cast("double").alias("k"),
        F.col("event_type").try_cast("int").alias("bad"))


@query("sca_05_date_trunc", with_views("score_log", """
    SELECT DATE_TRUNC('minute', scored_at)::TIMESTAMP AS bucket, COUNT(*) AS entries FROM score_log GROUP BY 1"""))
def minutes(spark, sf):
    return timeline(score_log(spark, sf), "MINUTE").withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query("sca_06_iso_timestamps", """
    SELECT event_id, DATE_TRUNC('second', ts)::TIMESTAMP AS parsed, HOUR(ts)::INT AS hour FROM events""")
def iso_timestamps(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    events = table(spark, sf, "events").select("event_id", text.alias("iso"))
    parsed = F.to_timestamp_ntz(F.col("iso"), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return events.select("event_id", parsed.alias("parsed"), F.hour(parsed).alias("hour"))


@query("sca_07_normalize", with_views("submissions", r"""
    SELECT event_id, REPLACE(REPLACE(REPLACE(LOWER(REGEXP_REPLACE('  ' || answer || '; A,B ', '^\s+|\s+$', '', 'g')), '%', ''), ',', ''), ';', ' ')
           AS normal FROM submissions"""))
def normalized(spark, sf):
    return submissions(spark, sf).select(
        "event_id", normalize(F.concat(F.lit("  "), "answer", F.lit("; A,B "))).alias("normal"))


@query("sca_08_numeric_tokens", with_views("submissions", r"""
    SELECT event_id, LEN(nums) AS n_numbers, nums[1] AS first_number FROM (
        SELECT event_id, LIST_TRANSFORM(LIST_FILTER(REGEXP_SPLIT_TO_ARRAY(REPLACE(LOWER(answer), '%', ''), '\s+'),
               lambda x: REGEXP_FULL_MATCH(x, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?')), lambda x: CAST(x AS DOUBLE)) AS nums FROM submissions)"""))
def numbers(spark, sf):
    tokens = numeric_tokens(normalize(F.col("answer")))
    return submissions(spark, sf).select(
        "event_id", F.size(tokens).cast("long").alias("n_numbers"), F.get(tokens, F.lit(0)).alias("first_number"))


@query("sca_09_truncate", "SELECT doc_id, LEFT(text, 120) AS head, SUBSTRING(text, 5, 10) AS part FROM documents")
def truncate(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", truncated(F.col("text"), 120).alias("head"), F.substring("text", 5, 10).alias("part"))


@query("sca_10_length_tiers", """
    SELECT doc_id, CASE WHEN LENGTH(text) > 200 THEN 5 WHEN LENGTH(text) > 50 THEN 3 ELSE 1 END AS points FROM documents""")
def length_tiers(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tier_points(F.length("text"), [(200, 5), (50, 3)], otherwise=1, strict=True).alias("points"))


@query("sca_11_text_tests", """
    SELECT doc_id, LOWER(text) LIKE '%the%' OR LOWER(text) LIKE '%eau%' AS has_word,
           text LIKE 'The%' OR text LIKE 'La%' AS has_prefix, REGEXP_MATCHES(text, '[0-9]') AS has_digit FROM documents""")
def text_tests(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", contains_any(text, ["the", "eau"]).alias("has_word"),
        starts_with_any(text, ["The", "La"]).alias("has_prefix"), has_digit(text).alias("has_digit"))


@query("sca_12_flatten_result", f"""
    SELECT STRING_AGG(CONCAT(quantity_group, ', ', n), '; ' ORDER BY n DESC, quantity_group) AS answer FROM (
        SELECT {QUANTITY_CASE} AS quantity_group, COUNT(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, quantity_group LIMIT 5)""")
def flattened(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy(quantity_group().alias("quantity_group")).agg(F.count("*").alias("n"))
    return flatten_result(counts, ["quantity_group", "n"], [F.desc("n"), F.asc("quantity_group")])


@query("sca_13_arithmetic_features", """
    SELECT l_orderkey, l_linenumber, 220 - l_quantity - l_tax AS reserve,
           CASE WHEN l_quantity > 30 AND l_discount > 0.05 THEN 1 ELSE 0 END AS both_high,
           CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS one_high, l_quantity * l_extendedprice AS product,
           l_extendedprice / (l_quantity + 1) AS ratio FROM lineitem""")
def arithmetic(spark, sf):
    quantity, discount = F.col("l_quantity"), F.col("l_discount")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", reserve(quantity, F.col("l_tax")).alias("reserve"),
        both_over(quantity, 30, discount, 0.05).alias("both_high"), over(discount, 0.05).alias("one_high"),
        (quantity * F.col("l_extendedprice")).alias("product"),
        per_plus_one(F.col("l_extendedprice"), quantity).alias("ratio"))
