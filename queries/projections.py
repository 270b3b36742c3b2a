"""Projections, filters, CASE."""

from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import intake_raw, with_views
from shoreline.functions.labels import bucketize, code_label, flag_label
from shoreline.operators.dedup import distinct_complete_rows, keep_earliest
from shoreline.operators.quality import invalid_code
from shoreline.operators.reshape import rename, select_existing, stamped


@query("prj_01_project", "SELECT event_id, user_id, value, value * 2 AS double_value, UPPER(event_type) AS kind FROM events")
def project(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "user_id", "value", (F.col("value") * 2).alias("double_value"), F.upper("event_type").alias("kind"))


@query("prj_02_drop_helper", with_views("intake_raw", """
    SELECT event_id, ts, user_id, event_type, value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts) AS rn FROM intake_raw) WHERE rn = 1"""))
def drop_helper(spark, sf):
    return keep_earliest(intake_raw(spark, sf), ["event_id"], "ts", ["value"])


@query("prj_03_rename", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice FROM orders")
def renamed(spark, sf):
    return rename(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                  {"o_orderkey": "order_id", "o_custkey": "customer_id"})


@query("prj_04_select_existing", "SELECT c_mktsegment, c_custkey FROM customer")
def existing(spark, sf):
    return select_existing(table(spark, sf, "customer"), ["c_mktsegment", "c_phone", "c_custkey", "c_comment"])


@query("prj_05_load_stamp", "SELECT event_id, value, 'alpha' AS team, TRUE AS has_stamp FROM events")
def load_stamp(spark, sf):
    rows = stamped(table(spark, sf, "events").select("event_id", "value"), team="alpha")
    return rows.select("event_id", "value", "team", F.col("ingested_at").isNotNull().alias("has_stamp"))


@query("flt_01_between", with_views("intake_raw", """
    SELECT COUNT(*) FILTER (WHERE value BETWEEN 0 AND 500) AS inside,
           COUNT(*) FILTER (WHERE value NOT BETWEEN 0 AND 500) AS outside, COUNT(*) AS n_rows FROM intake_raw"""))
def between(spark, sf):
    inside = F.col("value").between(0, 500)
    return intake_raw(spark, sf).agg(F.count_if(inside).alias("inside"), F.count_if(~inside).alias("outside"),
                                     F.count("*").alias("n_rows"))


@query("flt_02_conjunction", """
    SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
    WHERE l_quantity > 45 AND l_discount <= 0.05 AND l_returnflag IS NOT NULL AND l_shipdate >= TIMESTAMP '1997-01-01'""")
def conjunction(spark, sf):
    return table(spark, sf, "lineitem").filter(
        (F.col("l_quantity") > 45) & (F.col("l_discount") <= 0.05) & F.col("l_returnflag").isNotNull()
        & (F.col("l_shipdate") >= F.expr("TIMESTAMP_NTZ '1997-01-01'"))
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query("flt_03_sentinel_codes", with_views("intake_raw", """
    SELECT event_id, ts, value FROM intake_raw WHERE value IN (999, -1) OR value NOT BETWEEN 0 AND 500"""))
def sentinel_codes(spark, sf):
    return intake_raw(spark, sf).filter(invalid_code(F.col("value"), [999.0, -1.0], 0, 500)).select(
        "event_id", "ts", "value")


@query("flt_04_distinct_complete", with_views("intake_raw", """
    SELECT DISTINCT user_id, event_type, value FROM intake_raw WHERE value IS NOT NULL"""))
def distinct_complete(spark, sf):
    return distinct_complete_rows(intake_raw(spark, sf).select("user_id", "event_type", "value"))


@query("flt_05_fill_nulls", with_views("intake_raw", "SELECT event_id, ts, COALESCE(value, 0) AS value FROM intake_raw"))
def fill_nulls(spark, sf):
    return intake_raw(spark, sf).select("event_id", "ts", "value").na.fill(0, ["value"])


@query("case_01_buckets", """
    SELECT CASE WHEN l_quantity < 10 THEN 'under 10' WHEN l_quantity < 20 THEN '10-19'
                WHEN l_quantity < 30 THEN '20-29' ELSE '30+' END AS quantity_group, COUNT(*) AS n_rows
    FROM lineitem GROUP BY 1""")
def buckets(spark, sf):
    group = bucketize(F.col("l_quantity"), [10, 20, 30], ["under 10", "10-19", "20-29", "30+"])
    return table(spark, sf, "lineitem").groupBy(group.alias("quantity_group")).agg(F.count("*").alias("n_rows"))


@query("case_02_code_labels", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' END AS status_label,
           CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE '?' END AS status_or_mark FROM orders""")
def code_labels(spark, sf):
    names = {"O": "open", "F": "filled"}
    return table(spark, sf, "orders").select(
        "o_orderkey", code_label(F.col("o_orderstatus"), names).alias("status_label"),
        code_label(F.col("o_orderstatus"), names, "?").alias("status_or_mark"))


@query("case_03_flag_label", """
    SELECT doc_id, CASE WHEN toxic = 1 THEN 'Toxic' ELSE 'Clean' END AS verdict FROM labels""")
def flags(spark, sf):
    return table(spark, sf, "labels").select(
        "doc_id", flag_label(F.col("toxic") == 1, "Toxic", "Clean").alias("verdict"))
