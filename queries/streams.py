"""Structured Streaming: every query drains a landing folder and reads the stored result."""

from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import (CLEAN, COHORT, EVENT_SCHEMA, INTAKE_RULES, INTAKE_SCHEMA, MICROSECONDS, intake_raw, waves,
                              with_views)
from queries.sources import PER_TYPE, per_type
from shoreline.plans.live_gold import keep_gold, read_gold
from shoreline.plans.medallion import rollup
from shoreline.session import shared_folder
from shoreline.sinks.tables import overwrite_table
from shoreline.sources.files import file_inventory
from shoreline.streaming.changes import earliest_changes, log_changes, read_net
from shoreline.streaming.counts import RuleCounts, read_counts, total_counts
from shoreline.streaming.ingest import land, stream_files
from shoreline.streaming.rollup import activity, keep_current, keep_live, read_current, read_live, refresh_on_batch
from shoreline.streaming.silver import arrival_dedup, compact_log, log_earliest, read_earliest
from queries.sinks import fresh_name


def landing_stream(spark, df, schema):
    """A table landed as waves of files and streamed in about five micro-batches."""
    path = waves(df, "event_id")
    per_batch = max(1, file_inventory(spark, path, "*.json").count() // 5)
    return stream_files(spark, path, schema, files_per_batch=per_batch)


def cores(spark):
    return spark.sparkContext.defaultParallelism


def folders(spark, *names):
    return [shared_folder(spark, n) for n in names]


@query("str_01_streaming_bronze", with_views("intake_raw", "SELECT * FROM intake_raw"))
def bronze(spark, sf):
    out, mark = folders(spark, "bronze", "mark")
    land(landing_stream(spark, intake_raw(spark, sf), INTAKE_SCHEMA), out, mark)
    return spark.read.parquet(out)


@query("str_02_streaming_silver", with_views("silver", "SELECT * FROM silver"))
def silver(spark, sf):
    log, mark = folders(spark, "log", "mark")
    log_earliest(landing_stream(spark, intake_raw(spark, sf), INTAKE_SCHEMA), log, mark, CLEAN.key, CLEAN.time, CLEAN.tie_break)
    return read_earliest(spark, log, CLEAN.key, CLEAN.time, CLEAN.rules, CLEAN.tie_break)


@query("str_02_compacted_silver", with_views("silver", "SELECT * FROM silver"))
def compacted_silver(spark, sf):
    """Compacted between two drains of one stream, and again after them."""
    log, mark, landing = folders(spark, "log", "mark", "landing")
    raw = intake_raw(spark, sf)
    for part in (0, 1):
        raw.filter(F.pmod(F.xxhash64("ts"), F.lit(2)) == part).write.mode("append").option("timestampNTZFormat", MICROSECONDS).json(landing)
        log_earliest(stream_files(spark, landing, INTAKE_SCHEMA), log, mark, CLEAN.key, CLEAN.time, CLEAN.tie_break)
        compact_log(spark, log, CLEAN.key, CLEAN.time, CLEAN.tie_break)
    return read_earliest(spark, log, CLEAN.key, CLEAN.time, CLEAN.rules, CLEAN.tie_break)


@query("str_02_arrival_dedup", with_views("silver", "SELECT * FROM silver"))
def first_arrival(spark, sf):
    """Repeats arrive in a later drain, so the first arrival is the earliest row."""
    out, mark, landing = folders(spark, "arrival", "mark", "landing")
    raw = intake_raw(spark, sf)
    originals = table(spark, sf, "events").select("event_id", F.col("ts").alias("_first"))
    late = raw.join(originals, "event_id").withColumn("_late", F.col("ts") > F.col("_first")).drop("_first")
    for part in (False, True):
        late.filter(F.col("_late") == part).drop("_late").write.mode("append").option("timestampNTZFormat", MICROSECONDS).json(landing)
        stream = stream_files(spark, landing, INTAKE_SCHEMA)
        land(arrival_dedup(stream, CLEAN.key, CLEAN.rules), out, mark, state_partitions=cores(spark))
    return spark.read.schema(INTAKE_SCHEMA).parquet(out)


def ordered_landing(df, time, waves=5):
    """A table landed in waves of rising time, as a live source brings it."""
    spark, (path,) = df.sparkSession, folders(df.sparkSession, "landing")
    cuts = df.agg(F.percentile_approx(F.col(time).cast("timestamp").cast("double"), [i / waves for i in range(1, waves)], 1000)).collect()[0][0] or []
    at = F.col(time).cast("timestamp").cast("double")
    for low, high in zip([None, *cuts], [*cuts, None]):
        inside = (F.lit(True) if low is None else at > low) & (F.lit(True) if high is None else at <= high)
        df.filter(inside).coalesce(1).write.mode("append").option("timestampNTZFormat", MICROSECONDS).json(path)
    return path


@query("str_02_bounded_dedup", with_views("silver", "SELECT * FROM silver"))
def bounded(spark, sf):
    """Earliest row by event time; a key is forgotten two days after its last row."""
    out, mark = folders(spark, "bounded", "mark")
    landing = ordered_landing(intake_raw(spark, sf), CLEAN.time)
    stream = stream_files(spark, landing, INTAKE_SCHEMA, files_per_batch=1).withColumn("ts", F.col("ts").cast("timestamp"))
    changes = earliest_changes(stream, CLEAN.key, CLEAN.time, CLEAN.tie_break, delay="2 days")
    log_changes(changes, out, mark, state_partitions=cores(spark))
    return read_net(spark, out, CLEAN.key, CLEAN.rules).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("str_02_rule_counts", with_views("intake_raw", " UNION ALL ".join(
    f"SELECT '{r.name}' AS rule, '{r.action}' AS action, COUNT(*) FILTER ({r.constraint}) AS passed, COUNT(*) - COUNT(*) FILTER ({r.constraint}) AS failed FROM intake_raw"
    for r in INTAKE_RULES)))
def stream_rule_counts(spark, sf):
    """Counts of all rules taken as the rows pass, over two drains of one stream."""
    log, mark, counts, landing = folders(spark, "log", "mark", "counts", "landing")
    raw = intake_raw(spark, sf)
    listener = RuleCounts(spark, f"rules_{counts[-12:]}", INTAKE_RULES, counts)
    spark.streams.addListener(listener)
    try:
        for part in (0, 1):
            raw.filter(F.pmod(F.xxhash64("ts"), F.lit(2)) == part).write.mode("append").option("timestampNTZFormat", MICROSECONDS).json(landing)
            stream = listener.observed(stream_files(spark, landing, INTAKE_SCHEMA))
            listener.wait_for(log_earliest(stream, log, mark, CLEAN.key, CLEAN.time, CLEAN.tie_break))
    finally:
        spark.streams.removeListener(listener)
    return total_counts(read_counts(spark, counts))


@query("str_03_chained_layers", with_views("silver", "SELECT * FROM silver"))
def chained(spark, sf):
    bronze_path, bronze_mark, log, mark = folders(spark, "bronze", "mark", "log", "mark")
    land(landing_stream(spark, intake_raw(spark, sf), INTAKE_SCHEMA), bronze_path, bronze_mark)
    log_earliest(stream_files(spark, bronze_path, INTAKE_SCHEMA, format="parquet"), log, mark, CLEAN.key, CLEAN.time, CLEAN.tie_break)
    return read_earliest(spark, log, CLEAN.key, CLEAN.time, CLEAN.rules, CLEAN.tie_break)


@query("str_04_gold_refresh", with_views("gold", "SELECT * FROM gold"))
def gold_refresh(spark, sf):
    log, mark, refresh_mark, gold = folders(spark, "log", "mark", "mark", "gold")
    name = fresh_name("gold", gold)
    log_earliest(landing_stream(spark, intake_raw(spark, sf), INTAKE_SCHEMA), log, mark, CLEAN.key, CLEAN.time, CLEAN.tie_break)

    def refresh():
        cleaned = read_earliest(spark, log, CLEAN.key, CLEAN.time, CLEAN.rules, CLEAN.tie_break)
        overwrite_table(rollup(cleaned, COHORT), name, gold)

    refresh_on_batch(stream_files(spark, log, INTAKE_SCHEMA, format="parquet"), refresh, refresh_mark)
    return spark.table(name)


@query("str_04_gold_by_increments", with_views("gold", "SELECT * FROM gold"))
def gold_by_increments(spark, sf):
    """Cohorts kept from changes alone; repeats of a key arrive in any order."""
    gold, mark = folders(spark, "gold", "mark")
    stream = landing_stream(spark, intake_raw(spark, sf), INTAKE_SCHEMA)
    keep_gold(earliest_changes(stream, CLEAN.key, CLEAN.time, CLEAN.tie_break), COHORT, CLEAN.rules, gold, mark, state_partitions=cores(spark))
    return read_gold(spark, gold, COHORT)


@query("str_05_resume", f"""
    SELECT 'first drain' AS stage, COUNT(*) AS n_rows FROM events WHERE event_id % 2 = 0
    UNION ALL SELECT 'second drain', COUNT(*) FROM events""")
def resume(spark, sf):
    events = table(spark, sf, "events")
    landing, out, mark = folders(spark, "landing", "resumed", "mark")
    stages = []
    for part, stage in ((0, "first drain"), (1, "second drain")):
        events.filter(F.col("event_id") % 2 == part).write.mode("append").json(landing)
        land(stream_files(spark, landing, EVENT_SCHEMA), out, mark)
        seen = spark.read.parquet(out).agg(F.count("*").alias("n_rows")).collect()[0][0]
        stages.append((stage, seen))
    return spark.createDataFrame(stages, "stage string, n_rows long")


@query("str_05_resumed_content", PER_TYPE)
def resumed_content(spark, sf):
    events = table(spark, sf, "events")
    landing, out, mark = folders(spark, "landing", "resumed", "mark")
    for part in (0, 1):
        events.filter(F.col("event_id") % 2 == part).write.mode("append").json(landing)
        land(stream_files(spark, landing, EVENT_SCHEMA), out, mark)
    return per_type(spark.read.parquet(out))


@query("str_06_activity_timeline", "SELECT DATE_TRUNC('hour', ts)::TIMESTAMP AS bucket, COUNT(*) AS entries FROM events GROUP BY 1")
def activity_timeline(spark, sf):
    out, mark = folders(spark, "activity", "mark")
    stream = landing_stream(spark, table(spark, sf, "events"), EVENT_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
    keep_current(activity(stream, "ts", "1 hour"), out, mark, state_partitions=cores(spark))
    return read_current(spark, out).withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query("str_06_live_windows", "SELECT DATE_TRUNC('hour', ts)::TIMESTAMP AS bucket, COUNT(*) AS entries FROM events GROUP BY 1")
def live_windows(spark, sf):
    """Only open windows are kept current; those behind the watermark are settled."""
    out, mark = folders(spark, "live", "mark")
    landing = ordered_landing(table(spark, sf, "events").select(*[c.split()[0] for c in EVENT_SCHEMA.split(", ")]), "ts")
    stream = stream_files(spark, landing, EVENT_SCHEMA, files_per_batch=1).withColumn("ts", F.col("ts").cast("timestamp"))
    keep_live(activity(stream, "ts", "1 hour", delay="1 day"), out, mark, "bucket", "25 hours", state_partitions=cores(spark))
    return read_live(spark, out).withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))
