"""Writing and maintaining tables; each query reads back what it stored."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import (CLEAN, COHORT, INTAKE_SCHEMA, cohort_base, intake_raw, score_log, waves, with_views)
from shoreline.operators.cohort import cohort_table
from shoreline.operators.reshape import align_schema
from shoreline.plans.medallion import clean, rollup
from shoreline.session import shared_folder
from shoreline.sinks.tables import (append_rows, create_table_as, create_table_if_absent, define_view,
                                    insert_overwrite, overwrite_table, refresh_materialized, register_missing,
                                    write_clustered, write_csv, write_zordered)
from shoreline.sinks.versions import VersionedTable
from shoreline.streaming.ingest import land, stream_files

LOG_COLUMNS = {"team": "long", "event": "string", "category": "int", "points": "double", "max_points": "double",
               "scored_at": "timestamp_ntz"}


def fresh_name(stem, path):
    """Catalog name that no other run uses; the folder name already is unique."""
    return f"shoreline_{stem}_{path[-12:]}"


@query("snk_01_overwrite_table", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def overwrite(spark, sf):
    path = shared_folder(spark, "overwrite")
    name = fresh_name("overwrite", path)
    overwrite_table(table(spark, sf, "customer"), name, path)
    overwrite_table(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), name, path)
    return spark.table(name)


@query("snk_02_table_as_select", with_views("cohort_base", """
    SELECT code, flag, COUNT(*) AS n_rows, ROUND(AVG(l_quantity), 6) AS avg_quantity
    FROM cohort_base GROUP BY code, flag"""))
def table_as_select(spark, sf):
    path = shared_folder(spark, "ctas")
    name = fresh_name("ctas", path)
    cohort_base(spark, sf).createOrReplaceTempView(f"{name}_source")
    create_table_as(spark, name, f"""
        SELECT code, flag, COUNT(*) AS n_rows, ROUND(AVG(l_quantity), 6) AS avg_quantity
        FROM {name}_source GROUP BY code, flag""", path)
    return spark.table(name)


@query("snk_03_typed_create", with_views("score_log", """
    SELECT team, event, category, points, max_points, scored_at FROM score_log"""))
def typed_create(spark, sf):
    path = shared_folder(spark, "typed")
    name = fresh_name("typed", path)
    create_table_if_absent(spark, name, LOG_COLUMNS, path)
    append_rows(score_log(spark, sf), name)
    create_table_if_absent(spark, name, LOG_COLUMNS, path)
    return spark.table(name)


@query("snk_04_append_rows", with_views("score_log", """
    SELECT category, COUNT(*) AS n_rows, ROUND(SUM(points), 6) AS points FROM score_log GROUP BY category"""))
def append(spark, sf):
    path = shared_folder(spark, "append")
    name = fresh_name("append", path)
    create_table_if_absent(spark, name, LOG_COLUMNS, path)
    log = score_log(spark, sf)
    append_rows(log.filter("category < 2"), name)
    append_rows(log.filter("category >= 2"), name)
    return spark.table(name).groupBy("category").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("points"), 6).alias("points"))


@query("snk_05_register_missing", "SELECT s_suppkey AS team FROM supplier UNION SELECT user_id FROM events")
def register(spark, sf):
    path = shared_folder(spark, "register")
    name = fresh_name("register", path)
    create_table_if_absent(spark, name, {"team": "long"}, path)
    append_rows(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("team")), name)
    users = table(spark, sf, "events").select(F.col("user_id").alias("team"))
    register_missing(users, name, ["team"])
    register_missing(users, name, ["team"])
    return spark.table(name)


@query("snk_06_insert_overwrite", "SELECT event_id, event_type, value FROM events WHERE value >= 100")
def overwrite_rows(spark, sf):
    path = shared_folder(spark, "insert")
    name = fresh_name("insert", path)
    overwrite_table(table(spark, sf, "events").select("event_id", "event_type", "value"), name, path)
    insert_overwrite(spark.table(name).filter("value >= 100"), name)
    return spark.table(name)


def changed_customers(spark, sf):
    customer = table(spark, sf, "customer")
    corrected = customer.filter("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0))
    added = customer.filter("c_mktsegment = 'BUILDING'").withColumn("c_custkey", -F.col("c_custkey") - 1)
    return corrected.unionByName(added)


@query("snk_07_upsert", """
    SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer
    UNION ALL
    SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'""")
def upsert(spark, sf):
    versions = VersionedTable(spark, shared_folder(spark, "upsert"), ["c_custkey"])
    versions.write(table(spark, sf, "customer"))
    versions.upsert(changed_customers(spark, sf), ["c_custkey"])
    return versions.read()


@query("snk_08_update_delete", """
    SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
    FROM orders WHERE NOT (o_orderpriority = '5-LOW')""")
def update_delete(spark, sf):
    versions = VersionedTable(spark, shared_folder(spark, "update"), ["o_orderkey"])
    versions.write(table(spark, sf, "orders"))
    versions.update(F.col("o_totalprice") > 250000, {"o_orderstatus": F.lit("X")})
    versions.delete(F.col("o_orderpriority") == "5-LOW")
    return versions.read().select("o_orderkey", "o_orderstatus", "o_totalprice")


def three_versions(spark, sf):
    customer = table(spark, sf, "customer")
    versions = VersionedTable(spark, shared_folder(spark, "versions"), ["c_custkey"])
    versions.write(customer)
    versions.delete(F.col("c_acctbal") < 0)
    versions.update(F.lit(True), {"c_acctbal": F.col("c_acctbal") + 1})
    versions.restore(0)
    return versions


@query("snk_09_restore_version", "SELECT * FROM customer")
def restore(spark, sf):
    return three_versions(spark, sf).read()


@query("snk_09_version_history", """
    SELECT 0 AS version, 'WRITE' AS operation, COUNT(*) AS n_rows FROM customer
    UNION ALL SELECT 1, 'DELETE', COUNT(*) FROM customer WHERE NOT (c_acctbal < 0)
    UNION ALL SELECT 2, 'UPDATE', COUNT(*) FROM customer WHERE NOT (c_acctbal < 0)
    UNION ALL SELECT 3, 'RESTORE 0', COUNT(*) FROM customer""")
def history(spark, sf):
    return three_versions(spark, sf).history().select("version", "operation", F.col("rows").alias("n_rows"))


@query("snk_09_read_as_of", "SELECT * FROM customer WHERE NOT (c_acctbal < 0)")
def as_of(spark, sf):
    return three_versions(spark, sf).read(version=1)


@query("snk_10_csv_export", "SELECT * FROM nation")
def csv_export(spark, sf):
    path = shared_folder(spark, "export")
    write_csv(table(spark, sf, "nation"), path)
    return spark.read.schema("n_nationkey int, n_name string, n_regionkey int").option("header", True).csv(path)


@query("snk_11_streaming_sink", with_views("intake_raw", """
    SELECT event_id, ts, user_id, event_type, value FROM intake_raw"""))
def streaming_sink(spark, sf):
    landing = waves(intake_raw(spark, sf), "event_id")
    out, mark = shared_folder(spark, "bronze"), shared_folder(spark, "mark")
    land(stream_files(spark, landing, INTAKE_SCHEMA), out, mark)
    return spark.read.parquet(out)


@query("snk_12_materialized_refresh", with_views("gold", "SELECT * FROM gold"))
def materialized(spark, sf):
    path = shared_folder(spark, "refresh")
    return refresh_materialized(fresh_name("refresh", path),
                                lambda s: rollup(clean(intake_raw(s, sf), CLEAN), COHORT), spark, path)


@query("snk_13_view", """
    SELECT p_brand, p_type, COUNT(*) AS part_count, 
           SUM(CAST(ROUND(p_retailprice * 100) AS BIGINT))::DOUBLE / 100 / COUNT(*) AS avg_price,
           SUM(CAST(ROUND(p_size * 100) AS BIGINT))::DOUBLE / 100 / COUNT(*) AS avg_size FROM part GROUP BY p_brand, p_type""")
def view(spark, sf):
    define_view(cohort_table(table(spark, sf, "part"), {"p_brand": F.col("p_brand"), "p_type": F.col("p_type")},
                             {"avg_price": "p_retailprice", "avg_size": "p_size"}, "part_count", digits=None, scale=2),
                "shoreline_part_summary")
    return spark.table("shoreline_part_summary")


@query("snk_14_schema_alignment", """
    SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(NULL AS VARCHAR) AS channel FROM orders
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, NULL, 'web' FROM orders""")
def schema_alignment(spark, sf):
    target = {"o_orderkey": "long", "o_orderstatus": "string", "o_totalprice": "double",
              "o_orderpriority": "string", "channel": "string"}
    old = table(spark, sf, "orders")
    new = old.select("o_orderkey", F.col("o_orderstatus").alias("state"), F.col("o_totalprice").alias("price"),
                     F.lit("web").alias("channel"), F.lit(1).alias("loyalty"))
    return align_schema(old, target).unionByName(
        align_schema(new, target, {"state": "o_orderstatus", "price": "o_totalprice"}))


#: Rows of a clustered file.
CLUSTERED_ROWS = 7_500


@query("snk_15_clustered_layout", "SELECT COUNT(*) AS n_rows, 0::BIGINT AS overlapping_files FROM lineitem")
def clustered_layout(spark, sf):
    path = shared_folder(spark, "clustered")
    keys = ["l_shipdate", "l_returnflag"]
    write_clustered(table(spark, sf, "lineitem"), path, keys, files=max(1, table(spark, sf, "lineitem").count() // CLUSTERED_ROWS))
    ranges = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.min(F.struct(*keys)).alias("low"), F.max(F.struct(*keys)).alias("high"))
    previous = F.lag("high").over(Window.orderBy("low"))
    return ranges.withColumn("overlaps", F.coalesce(previous >= F.col("low"), F.lit(False))).agg(
        F.sum("n").alias("n_rows"), F.count_if("overlaps").alias("overlapping_files"))


@query("snk_15_z_order", "SELECT COUNT(*) AS n_rows, TRUE AS second_column_skips_files FROM lineitem")
def z_ordered_layout(spark, sf):
    """Files that a filter on the second column alone must read, beside a layout sorted by both."""
    lines, keys, files = table(spark, sf, "lineitem"), ["l_shipdate", "l_extendedprice"], 32
    folders = [shared_folder(spark, n) for n in ("zordered", "clustered")]
    write_zordered(lines, folders[0], keys, files=files)
    write_clustered(lines, folders[1], keys, files=files)
    limit = lines.agg(F.percentile_approx("l_extendedprice", 0.05)).scalar()
    touched = []
    for folder in folders:
        ranges = spark.read.parquet(folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("l_extendedprice").alias("low"))
        touched.append(ranges.filter(F.col("low") <= limit).agg(F.count("*")).scalar())
    return spark.read.parquet(folders[0]).agg(F.count("*").alias("n_rows")).withColumn("second_column_skips_files", touched[0] * 2 <= touched[1])
