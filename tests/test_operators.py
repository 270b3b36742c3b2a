"""Operators on small frames with ties, NULL, duplicates and hot keys, against brute force."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shoreline.operators import retrieval
from shoreline.operators.cohort import chi_squared, compare_metrics, distinct_joined, rate_by, share_of_total, top_value
from shoreline.operators.dedup import distinct_complete_rows, keep_earliest, keep_latest
from shoreline.operators.joins import (absent_keys, broadcast_if_small, feature_lookup, grid, left_with_defaults, require_unique,
                                       with_scalars)
from shoreline.operators.leaderboard import completion_rate, event_dimension, leaderboard
from shoreline.operators.quality import Rule, apply_rules, domain_report, rule_metrics
from shoreline.operators.ranking import (fixed_size_sample, gap_to_leader, global_rank, medal, rank_in_hash_order, top_k_per_group)
from shoreline.operators.reshape import align_schema, flatten_result, select_existing, wide_to_long
from shoreline.operators.retrieval import nearest, nearest_pruned, text_vectors, unusable_vectors
from shoreline.operators.routing import first_topic, topic_by_score, topic_sections
from shoreline.operators.scoring import first_correct, validate_submissions
from shoreline.plans.medallion import CleanSpec, RULES_FIRST, build_layers, clean, CohortSpec
from shoreline.session import shared_folder


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_keep_earliest_and_latest_with_ties_and_null_key(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 3, "c"), (1, 3, "b"), (None, 2, "d"), (None, 1, "e")], "id int, t int, v string")
    assert rows_of(keep_earliest(df, ["id"], "t", ["v"]), "id", "v") == [(1, "b"), (None, "e")]
    assert rows_of(keep_latest(df, ["id"], "t", ["v"]), "id", "v") == [(1, "a"), (None, "d")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=60))
def test_dedup_is_idempotent_and_keeps_minima(spark, pairs):
    df = spark.createDataFrame(pairs, "k int, t int")
    once = keep_earliest(df, ["k"], "t")
    expected = sorted((k, min(t for j, t in pairs if j == k)) for k in {k for k, _ in pairs})
    assert rows_of(once, "k", "t") == sorted(expected, key=repr)
    assert rows_of(keep_earliest(once, ["k"], "t"), "k", "t") == rows_of(once, "k", "t")


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = keep_earliest(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_distinct_complete_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None)], "x int, y string")
    assert rows_of(distinct_complete_rows(df), "x", "y") == [(1, "a")]


def test_order_of_rules_and_dedup_matters(spark):
    df = spark.createDataFrame([(1, 1, 999.0), (1, 2, 5.0), (2, 1, 7.0)], "id int, t int, v double")
    rules = [Rule("valid", "v BETWEEN 0 AND 500")]
    assert rows_of(clean(df, CleanSpec(["id"], "t", rules)), "id") == [(2,)]
    assert rows_of(clean(df, CleanSpec(["id"], "t", rules, order=RULES_FIRST)), "id") == [(1,), (2,)]


def test_rules_count_null_as_failure_and_observe(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,)], "v double")
    rules = [Rule("valid", "v >= 0"), Rule("small", "v < 1", "warn")]
    seen = Observation("rules")
    assert apply_rules(df, rules, seen).count() == 1
    assert seen.get == {"rows": 3, "valid": 2, "small": 2}
    assert rows_of(rule_metrics(df, rules), "rule", "action", "passed", "failed") == [("small", "warn", 1, 2), ("valid", "drop", 1, 2)]


def test_layers_are_stored_and_reconcile(spark):
    df = spark.createDataFrame([(1, 1, 5.0, 1), (1, 2, 6.0, 1), (2, 1, -3.0, 0), (3, 1, 50.0, 0)], "id int, t int, v double, target int")
    cohorts = CohortSpec("v", [10], ["low", "high"], "target = 1", ("yes", "no"), {"avg_v": "v"})
    raw, cleaned, cohort = build_layers(df, CleanSpec(["id"], "t", [Rule("positive", "v >= 0")]), cohorts, shared_folder(spark, "layers"))
    assert (raw.count(), cleaned.count(), cohort.count()) == (4, 2, 2)
    assert "ingested_at" in cleaned.columns


@pytest.mark.parametrize("partitions", [1, 7])
def test_global_rank_with_one_hot_value(spark, partitions):
    data = [(i, 0 if i % 3 else i) for i in range(3000)]
    df = spark.createDataFrame(data, "team int, points int").repartition(partitions)
    ranked = {r["team"]: r["rank"] for r in global_rank(df, [F.desc("points"), F.asc("team")]).collect()}
    expected = {t: i + 1 for i, (t, _) in enumerate(sorted(data, key=lambda x: (-x[1], x[0])))}
    assert ranked == expected


def test_global_rank_of_nothing(spark):
    assert global_rank(spark.createDataFrame([], "x int"), ["x"]).count() == 0


@pytest.mark.parametrize("buckets", [1, 8, 65536])
def test_rank_in_hash_order_is_a_permutation_per_group(spark, buckets):
    df = spark.range(500).select("id", F.when(F.col("id") % 5 == 0, "rare").when(F.col("id") == 1, None).otherwise("hot").alias("g"))
    got = rank_in_hash_order(df, ["g"], ["id"], 7, buckets).collect()
    for group, size in (("rare", 100), ("hot", 399), (None, 1)):
        assert sorted(r["_rank"] for r in got if r["g"] == group) == list(range(1, size + 1))
        assert {r["_size"] for r in got if r["g"] == group} == {size}


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(1000)
    first = rows_of(fixed_size_sample(df.repartition(3), ["id"], 50), "id")
    assert len(first) == 50 and first == rows_of(fixed_size_sample(df.repartition(8), ["id"], 50), "id")
    assert first != rows_of(fixed_size_sample(df, ["id"], 50, seed=1), "id")


def test_top_k_per_group_gap_and_medals(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "g string, v int")
    assert rows_of(top_k_per_group(df, ["g"], [F.desc("v")], 1), "g", "v") == [("a", 3), ("b", 2)]
    assert rows_of(gap_to_leader(df, "v"), "v", "gap_to_leader") == [(1, -2), (2, -1), (3, 0)]
    assert [r[0] for r in spark.range(1, 5).select(medal(F.col("id"))).collect()] == ["gold", "silver", "bronze", None]


@pytest.mark.parametrize("chunk", [1000, 3])
def test_grid_small_and_chunked(spark, chunk):
    rows = spark.range(20).withColumnRenamed("id", "team")
    dimension = spark.range(10).select(F.when(F.col("id") > 0, F.concat(F.lit("e"), "id")).alias("event"))
    cells = rows_of(grid(rows, dimension.union(dimension), "event", chunk), "team", "event")
    assert cells == sorted(((t, f"e{e}" if e else None) for t in range(20) for e in range(10)), key=repr)


def test_broadcast_only_when_small(spark):
    small, large = spark.range(5), spark.range(100)
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(small, 10)) and not hinted(broadcast_if_small(large, 10))
    assert not hinted(broadcast_if_small(small.withColumn("x", F.repeat(F.lit("y"), 100)), 10, max_bytes=50))


def test_joins(spark):
    left = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    right = spark.createDataFrame([(2, 5), (2, 5)], "k int, v int").distinct()
    assert rows_of(left_with_defaults(left, right, ["k"], {"v": 0}), "k", "v") == [(1, 0), (2, 5), (2, 5)]
    assert rows_of(absent_keys(left, right, ["k"]), "k") == [(1,)]
    assert feature_lookup(left, right, ["k"]).count() == 2
    with pytest.raises(ValueError, match="not unique"):
        require_unique(left, ["k"], "left")
    got = with_scalars(left.agg(F.count("*").alias("n")), (right, {"m": F.max("v"), "c": F.count("*")})).collect()[0]
    assert tuple(got) == (3, 5, 1)


def test_rates_shares_and_sets(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", None), ("a", 1)], "g string, y int")
    assert rows_of(rate_by(df, {"g": F.col("g")}, F.col("y") == 1), "g", "total", "hits", "rate_pct") == [("a", 3, 2, 66.7), ("b", 1, 0, 0.0)]
    assert rows_of(share_of_total(df, ["g"]), "g", "share_pct") == [("a", 75.0), ("b", 25.0)]
    assert rows_of(distinct_joined(df, ["g"], "y"), "g", "rows", "distinct_values", "joined") == [("a", 3, 2, "0, 1"), ("b", 1, 0, "")]
    assert rows_of(top_value(df, "y"), "y", "rows") == [(1, 2)]
    assert rows_of(domain_report(df, "g", ["a", "z"]), "value", "rows", "status") == [("a", 3, "ok"), ("b", 1, "unexpected"), ("z", 0, "missing")]


def test_metric_comparison_leaves_out_null_flags(spark):
    df = spark.createDataFrame([(1, 4.0), (0, 2.0), (None, 100.0)], "y int, m double")
    assert [tuple(r) for r in compare_metrics(df, F.col("y") == 1, ["m"], ("yes", "no")).collect()] == [("m", 4.0, 2.0, 100.0)]


def chi2_by_hand(cells):
    rows, columns = sorted({r for r, _ in cells}), sorted({c for _, c in cells})
    n = sum(cells.values())
    total = 0
    for r in rows:
        for c in columns:
            e = sum(v for (a, _), v in cells.items() if a == r) * sum(v for (_, b), v in cells.items() if b == c) / n
            total += (cells.get((r, c), 0) - e) ** 2 / e
    return total, (len(rows) - 1) * (len(columns) - 1)


def test_chi_squared_with_an_empty_cell(spark):
    cells = {("a", 0): 10, ("a", 1): 20, ("b", 0): 30, ("c", 0): 5, ("c", 1): 7}
    data = [k for k, v in cells.items() for _ in range(v)] + [(None, 1)]
    got = chi_squared(spark.createDataFrame(data, "r string, c int"), "r", "c").collect()[0]
    statistic, dof = chi2_by_hand(cells)
    assert got["chi2_statistic"] == pytest.approx(statistic) and got["degrees_of_freedom"] == dof == 2
    assert got["p_value"] == pytest.approx(math.exp(-statistic / 2)) and got["is_significant"]


@pytest.mark.parametrize("statistic, dof, p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (11.070498, 5, 0.05),
                                               (18.307038, 10, 0.05), (0.0, 3, 1.0), (6.634897, 1, 0.01), (16.811894, 6, 0.01)])
def test_chi_squared_tail_at_table_values(spark, statistic, dof, p):
    from shoreline.operators.cohort import _chi_squared_tail
    df = spark.createDataFrame([(statistic, dof)], "x double, d int")
    assert df.select(_chi_squared_tail()("x", "d")).collect()[0][0] == pytest.approx(p, abs=1e-6)


def test_reshape(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "id int, state string, price double")
    assert select_existing(df, ["price", "none", "id"]).columns == ["price", "id"]
    fitted = align_schema(df, {"id": "long", "status": "string", "note": "string", "kind": "string"}, {"state": "status"}, {"kind": "new"})
    assert fitted.dtypes == [("id", "bigint"), ("status", "string"), ("note", "string"), ("kind", "string")]
    assert tuple(fitted.collect()[0]) == (1, "x", None, "new")
    wide = spark.createDataFrame([("t", 1, 2)], "team string, a int, b int")
    assert rows_of(wide_to_long(wide, ["team"], ["a", "b"]), "team", "category", "points") == [("t", "a", 1), ("t", "b", 2)]


def test_flatten_result(spark):
    df = spark.createDataFrame([(i, f"v{i}" if i != 2 else None) for i in range(8)], "i int, v string")
    assert flatten_result(df, ["i", "v"], ["i"]).collect()[0][0] == "0, v0; 1, v1; 2; 3, v3; 4, v4"
    assert flatten_result(df.filter("i = 3"), ["i"], ["i"]).collect()[0][0] == "3"
    assert flatten_result(df.filter("i > 90"), ["i"], ["i"]).collect()[0][0] == ""


def test_topics(spark):
    df = spark.createDataFrame([("Rate the DRUG for a heart patient",), ("the weather",), ("heart",)], "q string")
    assert [r[0] for r in df.select(first_topic(F.col("q"))).collect()] == ["drug", "other", "heart"]
    assert [r[0] for r in df.select(topic_by_score(F.col("q"))).collect()] == ["clinical", "both", "clinical"]
    assert rows_of(topic_sections(df, "q"), "q", "topic") == sorted([
        ("Rate the DRUG for a heart patient", "heart"), ("Rate the DRUG for a heart patient", "drug"),
        ("the weather", "help"), ("heart", "heart")], key=repr)


def test_nearest_leaves_out_broken_vectors(spark):
    d = spark.createDataFrame([(1, [1.0, 0.0]), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [1.0, 0.0, 0.0]), (5, None), (6, [0.9, 0.1])],
                              "id int, v array<double>")
    q = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [float("nan"), 0.0]), ("c", None)], "qid string, v array<double>")
    assert rows_of(nearest(d, q, 5, "id", "v", "qid"), "qid", "id") == [("a", 1), ("a", 6)]
    assert rows_of(unusable_vectors(d, "v"), "id") == [(2,), (3,), (5,)]


def test_nearest_with_many_queries(spark):
    rng = np.random.default_rng(5)
    docs, queries = rng.normal(size=(300, 6)), rng.normal(size=(2000, 6))
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(docs)], "id int, v array<double>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "qid int, v array<double>")
    got = {r["qid"]: r["id"] for r in nearest(d, q, 1, "id", "v", "qid", digits=12, rows=64).collect()}
    unit = docs / np.linalg.norm(docs, axis=1, keepdims=True)
    assert [got[i] for i in range(2000)] == np.argmax(queries @ unit.T, axis=1).tolist()


@pytest.mark.parametrize("block", [512, 2])
def test_nearest_equals_brute_force(spark, block):
    rng = np.random.default_rng(3)
    docs = rng.normal(size=(200, 8)).astype("float32")
    docs[7] = docs[3]
    docs[11] = 0
    queries = rng.normal(size=(5, 8)).astype("float32")
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(docs)], "id int, v array<float>").repartition(5)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "qid int, v array<float>")
    got = {(r["qid"], r["rank"]): (r["id"], r["score"]) for r in nearest(d, q, 4, "id", "v", "qid", block=block).collect()}
    assert len(got) == 20
    for j, vector in enumerate(queries.astype("float64")):
        scores = []
        for i, doc in enumerate(docs.astype("float64")):
            length = np.linalg.norm(doc) * np.linalg.norm(vector)
            scores.append((-round(float(doc @ vector / length), 6) if length else 0.0, i))
        for rank, (score, i) in enumerate(sorted(scores)[:4], 1):
            assert got[(j, rank)][0] == i and got[(j, rank)][1] == pytest.approx(-score, abs=2e-6)


def test_nearest_with_equal_documents_prefers_the_smaller_id(spark):
    d = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], "id int, v array<double>").repartition(4)
    q = spark.createDataFrame([(0, [2.0, 4.0])], "qid int, v array<double>")
    assert [r["id"] for r in nearest(d, q, 3, "id", "v", "qid").orderBy("rank").collect()] == [0, 1, 2]


def test_text_search_finds_the_passage(spark):
    words = [f"word{i}" for i in range(300)]
    random.seed(1)
    texts = [(i, " ".join(random.choices(words, k=40))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc int, text string")
    asked = spark.createDataFrame([(i, " ".join(texts[i][1].split()[10:30])) for i in (4, 31, 59)], "q int, text string")
    d, q = text_vectors(docs, [docs, asked], "text")
    assert rows_of(nearest(d, q, 1, "doc", "embedding", "q"), "q", "doc") == [(31, 31), (4, 4), (59, 59)]


def test_submission_checks(spark):
    df = spark.createDataFrame([("q1", "sql"), ("q9", "sql"), ("Q2", "fax"), (None, "sql")], "question_id string, method string")
    assert [r["reason"] for r in validate_submissions(df, ["Q1", "Q2"], ["SQL"]).collect()] == [
        None, "unknown question", "unknown method", "unknown question"]
    checked = spark.createDataFrame([("q", "b", 2, True), ("q", "a", 2, True), ("q", "c", 1, False), ("r", "a", 1, None)],
                                    "question_id string, team string, submitted_at int, verdict boolean")
    assert rows_of(first_correct(checked), "question_id", "team", "bonus") == [("q", "a", 1)]


def test_leaderboard_details(spark):
    log = spark.createDataFrame([("a", "e1", "c", 5.0, 10.0, 1), ("a", "e1", "c", 7.0, 10.0, 2), ("b", "e1", "c", 7.0, 10.0, 3),
                                 ("b", "e2", "d", 0.0, 5.0, 4), ("x", "e2", "d", 5.0, 5.0, 9)],
                                "team string, event string, category string, points double, max_points double, scored_at int")
    teams = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "team string")
    board = [tuple(r) for r in leaderboard(log, teams).select(
        "rank", "team", "total_points", "pct", "events_done", "gap_to_leader", "last_scored", "medal").orderBy("rank").collect()]
    assert board == [(1, "a", 7.0, 46.7, 1, 0.0, 2, "gold"), (2, "b", 7.0, 46.7, 2, 0.0, 4, "silver"), (3, "c", 0.0, 0.0, 0, -7.0, None, "bronze")]
    configured = spark.createDataFrame([("e3",)], "event string")
    assert rows_of(completion_rate(log, teams, event_dimension(log, configured)), "event", "teams_submitted", "completion_pct") == [
        ("e1", 2, 67.0), ("e2", 1, 33.0), ("e3", 0, 0.0)]


@pytest.mark.parametrize("pivots", [1, 4, 64])
def test_pruned_search_equals_brute_force_and_skips(spark, pivots):
    import numpy as np
    rng = np.random.default_rng(pivots)
    centers = rng.normal(size=(8, 12)) * 6
    vectors = np.r_[np.concatenate([c + rng.normal(size=(40, 12)) for c in centers]), np.zeros((2, 12))]
    vectors[5] = vectors[6]
    docs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(900, None), (901, [float("nan")] * 12)], "id long, v array<double>")
    asked = docs.withColumnRenamed("id", "qid")
    got = nearest_pruned(docs, asked, 3, "id", "v", "qid", pivots=pivots, block=30)
    exact = nearest(docs, asked, 3, "id", "v", "qid")
    assert rows_of(got, "qid", "id", "score", "rank") == rows_of(exact, "qid", "id", "score", "rank")
    looked = got.agg(F.avg("looked_at")).collect()[0][0]
    assert looked <= 322 and (pivots < 64 or looked < 200)


def test_pruned_search_sends_a_query_once_to_each_block(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(240)]
    docs, asked = spark.createDataFrame(rows, "id int, v array<double>"), spark.createDataFrame(rows, "qid int, v array<double>")
    folder = shared_folder(spark, "pruned")
    monkeypatch.setattr(retrieval, "shared_folder", lambda *_: folder)
    got = nearest_pruned(docs, asked, 3, "id", "v", "qid", pivots=40, block=120)
    columns = ("qid", "id", "score", "rank")
    assert rows_of(got, *columns) == rows_of(nearest(docs, asked, 3, "id", "v", "qid"), *columns)
    sent = spark.read.parquet(f"{folder}/first").count() + spark.read.parquet(f"{folder}/more").count()
    assert sent <= 240 * 2 * 4 and spark.read.parquet(f"{folder}/docs").select("cluster").distinct().count() > 20


def test_pruned_search_writes_a_query_twice_at_most(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(f"v{i}", [rng.gauss(0, 1) for _ in range(12)]) for i in range(300)]
    rows += [(f"w{i}", rows[0][1]) for i in range(30)]
    docs, asked = spark.createDataFrame(rows, "id string, v array<float>"), spark.createDataFrame(rows, "qid string, v array<float>")
    folder = shared_folder(spark, "pruned")
    monkeypatch.setattr(retrieval, "shared_folder", lambda *_: folder)
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 50)
    got = nearest_pruned(docs, asked, 3, "id", "v", "qid", pivots=40, block=16)
    columns = ("qid", "id", "score", "rank")
    assert rows_of(got, *columns) == rows_of(nearest(docs, asked, 3, "id", "v", "qid"), *columns)
    assert spark.read.parquet(f"{folder}/docs").select("block").distinct().count() >= 20
    first, more = (spark.read.parquet(f"{folder}/{x}").count() for x in ("first", "more"))
    assert first == 330 and 0 < more <= 330


@pytest.mark.parametrize("n", [0, 1, 200])
def test_pruned_search_with_few_queries_or_documents(spark, n):
    rng = random.Random(n)
    docs = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(n)], "id int, v array<double>")
    asked = spark.createDataFrame([(1, [0.5, 0.1, 0.0, 0.2, 1.0]), (2, [0.0] * 5), (3, None)], "qid int, v array<double>")
    got = nearest_pruned(docs, asked, 3, "id", "v", "qid", pivots=2, block=10)
    columns = ("qid", "id", "score", "rank")
    assert rows_of(got, *columns) == rows_of(nearest(docs, asked, 3, "id", "v", "qid"), *columns)
    assert got.count() == 2 * min(n, 3)


def test_a_task_of_a_search_holds_few_bytes(spark):
    assert retrieval.ROW_BLOCK * 1024 * 8 <= 32 << 20
    narrow = spark.createDataFrame([(1, [0.5, 0.25])], "id int, v array<float>")
    assert narrow.select(retrieval._numbers(narrow, "v")).schema[0].dataType.simpleString() == "array<float>"
