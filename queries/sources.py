"""Scans."""

from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import EVENT_SCHEMA, intake_raw, waves, with_views
from shoreline.session import shared_folder
from shoreline.sources.files import (CORPUS_FOLDER, file_inventory, read_corpus, read_csv, read_json_array, read_ndjson,
                                     rows_per_file, write_corpus)
from shoreline.sources.generate import Choice, DoubleRange, IntRange, RiskFlag, generate_over
from shoreline.sources.tables import inline_rows, scan_table, stream_table
from shoreline.streaming.ingest import land, stream_files

PER_TYPE = """SELECT event_type, COUNT(*) AS n_rows, ROUND(SUM(value), 6) AS value_sum, MAX(event_id) AS last_id
              FROM events GROUP BY event_type"""


def per_type(df):
    return df.groupBy("event_type").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("value"), 6).alias("value_sum"),
        F.max("event_id").alias("last_id"))


@query("src_01_ndjson_scan", PER_TYPE)
def ndjson_scan(spark, sf):
    path = waves(table(spark, sf, "events"), "event_id")
    return per_type(read_ndjson(spark, path))


@query("src_01_ndjson_scan_typed", PER_TYPE)
def ndjson_scan_typed(spark, sf):
    path = waves(table(spark, sf, "events"), "event_id")
    return per_type(read_ndjson(spark, path, EVENT_SCHEMA))


@query("src_02_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark, sf):
    path = shared_folder(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return read_csv(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("long"))


def write_json_arrays(df, path):
    """One JSON array per task; rows stream through, nothing is collected."""
    def wrap(frames):
        import pandas as pd
        first = True
        yield pd.DataFrame({"value": ["["]})
        for frame in frames:
            lines = frame["value"].tolist()
            if lines:
                yield pd.DataFrame({"value": [("" if first and i == 0 else ",") + x for i, x in enumerate(lines)]})
                first = False
        yield pd.DataFrame({"value": ["]"]})

    df.select(F.to_json(F.struct(*df.columns)).alias("value")).mapInPandas(wrap, "value string").write.text(path)


@query("src_03_json_array_scan", """
    SELECT 'NOTE_' || LPAD(CAST(rn AS VARCHAR), CAST(GREATEST(3, LENGTH(CAST(rn AS VARCHAR))) AS INT), '0') AS note_id,
           conv_id, turn, role, LENGTH(text) AS n_chars
    FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY conv_id, turn) AS rn FROM conversations)""")
def json_array_scan(spark, sf):
    path = shared_folder(spark, "arrays")
    write_json_arrays(table(spark, sf, "conversations"), path)
    notes = read_json_array(spark, path, "conv_id long, turn long, role string, text string",
                            id_column="note_id", order=["conv_id", "turn"])
    return notes.select("note_id", "conv_id", "turn", "role", F.length("text").cast("long").alias("n_chars"))


@query("src_04_incremental_files", PER_TYPE)
def incremental_files(spark, sf):
    landing = waves(table(spark, sf, "events"), "event_id")
    out, mark = shared_folder(spark, "drained"), shared_folder(spark, "mark")
    per_batch = max(1, file_inventory(spark, landing, "*.json").count() // 5)
    land(stream_files(spark, landing, EVENT_SCHEMA, files_per_batch=per_batch), out, mark)
    return per_type(spark.read.parquet(out))


@query("src_05_named_table_scan", f"""
    SELECT 'batch' AS mode, * FROM ({PER_TYPE}) UNION ALL SELECT 'stream' AS mode, * FROM ({PER_TYPE})""")
def named_table_scan(spark, sf):
    path = shared_folder(spark, "named")
    name = f"shoreline_named_{path[-12:]}"
    table(spark, sf, "events").write.mode("overwrite").option("path", path).saveAsTable(name)
    out, mark = shared_folder(spark, "drained"), shared_folder(spark, "mark")
    land(stream_table(spark, name), out, mark)
    batch = per_type(scan_table(spark, name)).withColumn("mode", F.lit("batch"))
    return batch.unionByName(per_type(spark.read.parquet(out)).withColumn("mode", F.lit("stream")))


@query("src_06_file_inventory", "SELECT COUNT(*) AS total_rows, TRUE AS every_file_listed, TRUE AS has_bytes FROM events")
def inventory(spark, sf):
    path = waves(table(spark, sf, "events"), "event_id")
    listed = file_inventory(spark, path, "*.json").withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    counted = rows_per_file(read_ndjson(spark, path, EVENT_SCHEMA)).withColumn(
        "path", F.regexp_replace("path", "^file:/+", "/"))
    both = counted.join(listed, "path", "full")
    return both.agg(F.sum("rows").alias("total_rows"),
                    F.bool_and(F.col("rows").isNotNull() & F.col("bytes").isNotNull()).alias("every_file_listed"),
                    F.bool_and(F.col("bytes") > 0).alias("has_bytes"))


@query("src_07_document_corpus", "SELECT doc_id, LENGTH(text) AS n_chars, MD5(text) AS digest FROM documents")
def document_corpus(spark, sf):
    path = shared_folder(spark, "corpus")
    files = write_corpus(table(spark, sf, "documents"), path, "doc_id")
    tasks = max(4 * spark.sparkContext.defaultParallelism, files // CORPUS_FOLDER)
    docs = read_corpus(spark, path, tasks).withColumn("text", F.regexp_replace("text", r"\n\z", ""))
    doc_id = F.nullif(F.substring_index("file_name", ".", 1), F.lit("null"))
    return docs.select(doc_id.cast("long").alias("doc_id"),
                       F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"))


@query("src_08_inline_dimension", """
    SELECT d.event_type, d.max_points, COUNT(e.event_id) AS n_rows
    FROM (VALUES ('click', 55.0::DOUBLE), ('view', 48.0::DOUBLE), ('purchase', 48.0::DOUBLE), ('signup', 48.0::DOUBLE),
                 ('error', 35.0::DOUBLE), ('refund', 0.0::DOUBLE)) AS d(event_type, max_points)
    LEFT JOIN events e ON e.event_type = d.event_type GROUP BY 1, 2""")
def inline_dimension(spark, sf):
    dimension = inline_rows(spark, [("click", 55.0), ("view", 48.0), ("purchase", 48.0), ("signup", 48.0),
                                    ("error", 35.0), ("refund", 0.0)], "event_type string, max_points double")
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n_rows"))
    return dimension.join(counts, "event_type", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


@query("src_09_generated_table", """
    SELECT COUNT(*) AS n_rows, 0::BIGINT AS out_of_range, 0::BIGINT AS changed_on_repeat, 3::BIGINT AS kinds, 2::BIGINT AS targets FROM events""")
def generated_table(spark, sf):
    spec = {"age": IntRange(29, 78), "chol": IntRange(126, 565), "oldpeak": DoubleRange(0.0, 6.2),
            "kind": Choice(["a", "b", "c"], [0.4, 0.35, 0.25]),
            "target": RiskFlag({"age": (55, 0.3), "chol": (240, 0.3), "oldpeak": (2.0, 0.3)})}
    ids = table(spark, sf, "events").select("event_id")
    columns = ["age", "chol", "oldpeak", "kind", "target"]
    made = generate_over(ids, spec, 42, "event_id")
    again = generate_over(ids.repartition(3), spec, 42, "event_id").select("event_id", F.xxhash64(*columns).alias("_again"))
    good = (F.col("age").between(29, 78) & F.col("chol").between(126, 565) & F.col("oldpeak").between(0, 6.2)
            & F.col("kind").isin("a", "b", "c") & F.col("target").isin(0, 1))
    return made.join(again, "event_id").agg(
        F.count("*").alias("n_rows"), F.count_if(~F.coalesce(good, F.lit(False))).alias("out_of_range"),
        F.count_if(F.xxhash64(*columns) != F.col("_again")).alias("changed_on_repeat"),
        F.count_distinct("kind").alias("kinds"), F.count_distinct("target").alias("targets"))


@query("src_10_inject_defects", with_views("intake_raw", """
    SELECT COUNT(*) AS n_rows, COUNT(DISTINCT event_id) AS distinct_ids,
           COUNT(*) FILTER (WHERE value IS NULL) AS nulls, COUNT(*) FILTER (WHERE value = 999) AS sentinels,
           COUNT(*) FILTER (WHERE value = -1) AS negatives, ROUND(SUM(value), 6) AS value_sum FROM intake_raw"""))
def defects(spark, sf):
    v = F.col("value")
    return intake_raw(spark, sf).agg(
        F.count("*").alias("n_rows"), F.count_distinct("event_id").alias("distinct_ids"),
        F.count_if(v.isNull()).alias("nulls"), F.count_if(v == 999).alias("sentinels"),
        F.count_if(v == -1).alias("negatives"), F.round(F.sum("value"), 6).alias("value_sum"))
