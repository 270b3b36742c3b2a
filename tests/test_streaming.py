"""Streams: drained results equal the batch operators, restarts read only what is new."""

import os
import random

import pytest
from pyspark.sql import functions as F

from shoreline.operators.quality import Rule, rule_metrics
from shoreline.session import shared_folder
from shoreline.streaming.ingest import land, stream_files
from shoreline.plans.live_gold import keep_gold, read_gold
from shoreline.plans.medallion import CleanSpec, CohortSpec, clean, rollup
from shoreline.streaming.changes import earliest_changes, late_rows, log_changes, read_net
from shoreline.streaming.counts import RuleCounts, read_counts, total_counts
from shoreline.streaming.rollup import activity, keep_current, keep_live, read_current, read_live
from shoreline.streaming.silver import BATCH, bounded_dedup, candidates, compact_log, live_folders, log_earliest, read_earliest
from shoreline.streaming.states import StateFolder

SCHEMA = "id int, t int, v double"
RULES = [Rule("valid", "v BETWEEN 0 AND 500")]
BATCHES = [[(1, 5, 1.0), (2, 5, 999.0), (1, 4, 2.0)], [(1, 1, -1.0), (2, 9, 7.0), (3, 1, 3.0)], [(3, 0, 4.0), (4, 2, None)]]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def add_file(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_streamed_silver_equals_batch_for_any_arrival(spark, order):
    landing, log, mark = (shared_folder(spark, n) for n in ("landing", "log", "mark"))
    for i in order:
        add_file(spark, landing, BATCHES[i])
        log_earliest(stream_files(spark, landing, SCHEMA), log, mark, ["id"], "t")
    everything = spark.createDataFrame([r for b in BATCHES for r in b], SCHEMA)
    batch = rows_of(clean(everything, CleanSpec(["id"], "t", RULES)), "id", "t", "v")
    assert batch == [(3, 0, 4.0)]
    assert rows_of(read_earliest(spark, log, ["id"], "t", RULES), "id", "t", "v") == batch
    assert compact_log(spark, log, ["id"], "t") == 2
    assert candidates(spark, log).count() == 4
    assert rows_of(read_earliest(spark, log, ["id"], "t", RULES), "id", "t", "v") == batch


def test_restart_reads_only_new_files(spark):
    landing, out, mark = (shared_folder(spark, n) for n in ("landing", "out", "mark"))
    add_file(spark, landing, BATCHES[0])
    land(stream_files(spark, landing, SCHEMA), out, mark)
    add_file(spark, landing, BATCHES[1])
    query = land(stream_files(spark, landing, SCHEMA), out, mark)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3
    land(stream_files(spark, landing, SCHEMA), out, mark)
    assert spark.read.parquet(out).count() == 6


def test_bounded_dedup_drops_repeats_across_batches(spark):
    landing, out, mark = (shared_folder(spark, n) for n in ("landing", "out", "mark"))
    schema = "id int, t timestamp"
    for rows in ([(1, 0), (2, 10)], [(1, 20), (3, 30)]):
        add_file(spark, landing, [(i, s) for i, s in rows], "id int, s int")
        stream = stream_files(spark, landing, "id int, s int").select("id", F.timestamp_seconds("s").alias("t"))
        land(bounded_dedup(stream, ["id"], "t", "1 hour", []), out, mark)
    assert rows_of(spark.read.schema(schema).parquet(out), "id") == [(1,), (2,), (3,)]


def test_activity_keeps_open_windows(spark):
    landing, out, mark = (shared_folder(spark, n) for n in ("landing", "out", "mark"))
    for rows in ([(0,), (59,), (60,)], [(30,), (3600,)]):
        add_file(spark, landing, rows, "s int")
        stream = stream_files(spark, landing, "s int").select(F.timestamp_seconds("s").alias("t"))
        keep_current(activity(stream, "t"), out, mark)
    got = {r["bucket"].minute + 60 * r["bucket"].hour: r["entries"] for r in read_current(spark, out).collect()}
    assert got == {0: 3, 1: 1, 60: 1}


ROWS = "id long, ts timestamp, v double, kind string"
COHORTS = CohortSpec("v", [100], ["low", "high"], "kind = 'x'", ("X", "other"), {"avg_v": "v"}, ("size", "kind_of", "n"), digits=None, scale=2)


def random_rows(seed, count=60):
    rng = random.Random(seed)
    return [(rng.randrange(12) if rng.random() < 0.95 else None, rng.choice([None, rng.randrange(40)]), rng.choice([None, round(rng.uniform(-5, 200), 2), 999.0]),
             rng.choice(["x", "y"])) for _ in range(count)]


def as_rows(spark, rows):
    return spark.createDataFrame(rows, "id long, s long, v double, kind string").select("id", F.timestamp_seconds("s").alias("ts"), "v", "kind")


def changes_of(spark, landing, **kw):
    return earliest_changes(stream_files(spark, landing, ROWS), ["id"], "ts", ["v", "kind"], **kw)


def test_gold_by_increments_equals_batch_after_every_micro_batch(spark):
    landing, gold, mark = (shared_folder(spark, n) for n in ("landing", "gold", "mark"))
    seen, spec = [], CleanSpec(["id"], "ts", RULES, ["v", "kind"])
    for i in range(4):
        rows = random_rows(i)
        seen += rows
        as_rows(spark, rows).coalesce(1).write.mode("append").json(landing)
        query = keep_gold(changes_of(spark, landing), COHORTS, RULES, gold, mark)
        assert sum(p["numInputRows"] for p in query.recentProgress) == len(rows)
        batch = rows_of(rollup(clean(as_rows(spark, seen), spec), COHORTS), "size", "kind_of", "n", "avg_v")
        assert rows_of(read_gold(spark, gold, COHORTS), "size", "kind_of", "n", "avg_v") == batch
    assert len(StateFolder(spark, gold).batches()) == 2


def test_changes_add_up_to_the_batch_result(spark):
    landing, log, mark = (shared_folder(spark, n) for n in ("landing", "log", "mark"))
    seen = []
    for i in range(3):
        rows = random_rows(10 + i) + [(77, 5, float("nan"), "y"), (77, 5, 7.0, "x")]
        seen += rows
        as_rows(spark, rows).write.mode("append").json(landing)
        log_changes(changes_of(spark, landing), log, mark)
    batch = clean(as_rows(spark, seen), CleanSpec(["id"], "ts", RULES, ["v", "kind"]))
    assert rows_of(read_net(spark, log, ["id"], RULES), "id", "ts", "v", "kind") == rows_of(batch, "id", "ts", "v", "kind")


def test_keys_are_forgotten_behind_the_watermark_and_late_rows_counted(spark):
    landing, log, mark = (shared_folder(spark, n) for n in ("landing", "log", "mark"))
    hour, late, states = 3600, 0, []
    for rows in ([(1, 2 * hour), (1, hour), (2, hour)], [(3, 30 * hour), (3, 29 * hour)], [(4, 60 * hour)], [(5, 90 * hour), (1, hour), (4, 89 * hour)]):
        as_rows(spark, [(i, s, 1.0, "x") for i, s in rows]).coalesce(1).write.mode("append").json(landing)
        query = log_changes(changes_of(spark, landing, delay="5 hours"), log, mark)
        late += late_rows(query)
        states.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    assert late == 1 and max(states) <= 4 and states[-1] < 5
    got = rows_of(read_net(spark, log, ["id"], []).withColumn("h", (F.unix_timestamp("ts") / hour).cast("int")), "id", "h")
    assert got == [(1, 1), (2, 1), (3, 29), (4, 60), (5, 90)]


def test_compaction_under_a_running_stream(spark):
    landing, log, mark = (shared_folder(spark, n) for n in ("landing", "log", "mark"))

    def drain(i):
        add_file(spark, landing, BATCHES[i])
        log_earliest(stream_files(spark, landing, SCHEMA), log, mark, ["id"], "t")

    def silver():
        return rows_of(read_earliest(spark, log, ["id"], "t", RULES), "id", "t", "v")
    drain(0)
    compact_log(spark, log, ["id"], "t")
    drain(1)
    before = silver()
    half = os.path.join(log.removeprefix("file:"), "_compacted", "compacted=1")
    os.makedirs(half)  # a compaction that died
    assert silver() == before and len(live_folders(spark, log)[1]) == 2
    assert compact_log(spark, log, ["id"], "t") == 1 and silver() == before
    assert len(live_folders(spark, log)[1]) == 1 and compact_log(spark, log, ["id"], "t") == 1
    assert not os.path.exists(os.path.join(log.removeprefix("file:"), f"{BATCH}=0"))
    drain(2)
    everything = spark.createDataFrame([r for b in BATCHES for r in b], SCHEMA)
    assert silver() == rows_of(clean(everything, CleanSpec(["id"], "t", RULES)), "id", "t", "v")


def test_rule_counts_of_a_stream_equal_the_batch_report_after_a_restart(spark):
    landing, log, mark, counts = (shared_folder(spark, n) for n in ("landing", "log", "mark", "counts"))
    rules = RULES + [Rule("named", "id > 1", "warn")]
    for i in range(3):
        add_file(spark, landing, BATCHES[i])
        listener = RuleCounts(spark, "test_rules", rules, counts)
        spark.streams.addListener(listener)
        try:
            query = log_earliest(listener.observed(stream_files(spark, landing, SCHEMA)), log, mark, ["id"], "t")
            listener.wait_for(query)
        finally:
            spark.streams.removeListener(listener)
    everything = spark.createDataFrame([r for b in BATCHES for r in b], SCHEMA)
    columns = ("rule", "action", "passed", "failed")
    assert rows_of(total_counts(read_counts(spark, counts)), *columns) == rows_of(rule_metrics(everything, rules), *columns)
    assert read_counts(spark, counts).select("micro_batch").distinct().count() == 3


def test_live_windows_settle_and_two_states_stay(spark):
    landing, out, mark = (shared_folder(spark, n) for n in ("landing", "out", "mark"))
    minutes = [[0, 0, 1, 5], [5, 6, 7, 20], [19, 21, 40], [41, 42, 90], [91]]
    for rows in minutes:
        add_file(spark, landing, [(m * 60,) for m in rows], "s int")
        stream = stream_files(spark, landing, "s int").select(F.timestamp_seconds("s").alias("t"))
        keep_live(activity(stream, "t", delay="10 minutes"), out, mark, "bucket", "11 minutes")
    got = {int(r["bucket"].timestamp() // 60): r["entries"] for r in read_live(spark, out).collect()}
    expected = {}
    for rows in minutes:
        for m in rows:
            expected[m] = expected.get(m, 0) + 1
    assert got == expected
    states = StateFolder(spark, os.path.join(out, "open"))
    assert len(states.batches()) == 2 and {int(r["bucket"].timestamp() // 60) for r in states.current().collect()} == {90, 91}


@pytest.mark.parametrize("delay", [None, "5 hours"])
def test_many_keys_share_few_states(spark, delay):
    landing, log, mark = (shared_folder(spark, n) for n in ("landing", "log", "mark"))
    seen = []
    for i in range(2):
        rows = [(n % 90, 1000 + (n * 37 + i) % 50, float(n % 7), "x") for n in range(180)]
        seen += rows
        as_rows(spark, rows).coalesce(1).write.mode("append").json(landing)
        query = log_changes(changes_of(spark, landing, delay=delay, buckets=4), log, mark)
    assert max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= 4
    batch = clean(as_rows(spark, seen), CleanSpec(["id"], "ts", RULES, ["v", "kind"]))
    assert rows_of(read_net(spark, log, ["id"], RULES), "id", "ts", "v", "kind") == rows_of(batch, "id", "ts", "v", "kind")
