"""Model calls and machine learning, by invariants."""

import glob
import os
import threading

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shoreline.ml.features import clinical_features, store_features
from shoreline.ml.metrics import class_report, classification_metrics, roc_auc
from shoreline.ml import shapley
from shoreline.ml.models import (ROWS_A_TASK, cross_validate, fit, fold_summary, gradient_boosting, importances, logistic_regression,
                                 random_forest, scored, soft_vote, spread)
from shoreline.ml.registry import best_run, final_metric, load_model, register_model, registered_models, run_row
from shoreline.ml.shapley import shapley_importances, shapley_values
from shoreline.ml.split import stratified_folds, stratified_split
from shoreline.ml.trees import importances_by_nodes, node_table, score_by_nodes
from shoreline.operators.model_calls import choose_demonstrations, choose_prompt, rule_client, score_rows
from shoreline.operators.scoring import judge_unknown
from shoreline.plans import learning
from shoreline.plans.briefing import risk_prompt
from shoreline.session import shared_folder


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_each_prompt_is_asked_once(spark):
    folder = shared_folder(spark, "calls")
    os.makedirs(folder)

    def client(prompts):
        import uuid
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(prompts))
        return [p.upper() for p in prompts]

    df = spark.createDataFrame([("a",)] * 50 + [("b",), (None,)], "p string").repartition(4)
    result = score_rows(df, "p", client, batch=1)
    assert result.count() == 52
    assert rows_of(result.distinct(), "p", "response") == sorted([("a", "A"), ("b", "B"), (None, None)], key=repr)
    asked = sorted(line for f in glob.glob(f"{folder}/*") for line in open(f).read().split("\n"))
    assert asked == ["a", "b"]


def test_failed_batches_are_retried_then_reported(spark):
    def client(prompts):
        if prompts == ["bad"]:
            raise RuntimeError("down")
        return prompts if prompts != ["short"] else []

    df = spark.createDataFrame([("good",), ("bad",), ("short",)], "p string")
    got = rows_of(score_rows(df, "p", client, error="why", batch=1, attempts=2), "p", "response", "why")
    assert got == [("bad", None, "RuntimeError: down"), ("good", "good", None), ("short", None, "0 answers to 1 prompts")]


def test_one_bad_prompt_loses_one_answer(spark):
    def client(prompts):
        if "p77" in prompts:
            raise RuntimeError("bad prompt")
        return [p.upper() for p in prompts]

    df = spark.range(201).select(F.concat(F.lit("p"), "id").alias("p"))
    got = score_rows(df, "p", client, error="why", batch=64, attempts=1, tasks=2)
    assert rows_of(got.filter("response IS NULL"), "p", "why") == [("p77", "RuntimeError: bad prompt")]
    assert got.filter("response = upper(p)").count() == 200
    with pytest.raises(Exception, match="no answer to a prompt"):
        score_rows(df, "p", client, attempts=1, strict=True)


def test_rule_client_reads_prompts(spark):
    df = spark.createDataFrame([(62.0, 280.0, 155.0, 140.0), (52.0, 230.0, 138.0, 90.0), (30.0, 300.0, 170.0, 150.0)],
                               "age double, chol double, bp double, hr double")
    prompts = [r[0] for r in df.select(risk_prompt(*[F.col(c) for c in df.columns])).collect()]
    assert rule_client()(prompts) == ["HIGH", "MEDIUM", "LOW"]


def test_prompt_choice_ignores_case_and_blanks(spark):
    df = spark.createDataFrame([("yes", "x"), (" NO ", "y")], "label string, q string")
    got = choose_prompt(df, {"good": F.col("q"), "bad": F.lit("x")}, "label", lambda ps: ["Yes" if p == "x" else "no" for p in ps])
    assert [tuple(r) for r in got.collect()] == [("good", 2, 0, 1.0), ("bad", 2, 0, 0.5)]


def test_failed_calls_are_no_wrong_answers(spark):
    def client(prompts):
        if any(p.startswith("x3") for p in prompts):
            raise RuntimeError("down")
        return ["yes"] * len(prompts)
    df = spark.createDataFrame([("yes", f"x{i}") for i in range(4)], "label string, q string")
    got = choose_prompt(df, {"plain": F.col("q"), "other": F.concat(F.col("q"), F.lit("!"))}, "label", client).collect()
    assert [(r.examples, r.failed, r.accuracy) for r in got] == [(4, 1, 1.0)] * 2


def test_a_hot_prompt_moves_once_per_task(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id").cast("string"))).alias("p")).repartition(4)
    seen = score_rows(df, "p", lambda ps: ps)
    assert seen.filter("response <> p OR response IS NULL").count() == 0
    asked = df.select(F.col("p").alias("_asked"), F.xxhash64("p").alias("_h1")).dropDuplicates(["_h1"])
    assert "partial_first" in asked._jdf.queryExecution().executedPlan().toString()


def test_demonstrations_have_the_winner_of_full_scoring(spark):
    def client(prompts):
        out = []
        for p in prompts:
            *shown, asked = p.split("\n")
            pairs = [(abs(int(x.split(":")[0]) - int(asked)), x.split(":")[1]) for x in shown]
            if asked == "13" and shown:
                raise RuntimeError("down")
            out.append(min(pairs)[1] if pairs else "b" if int(asked) > 90 else "a")
        return out
    df = spark.createDataFrame([(i, str(i), "b" if i > 60 else "a") for i in range(120)], "k long, q string, label string")
    got = choose_demonstrations(df, "q", "label", "k", lambda shots: F.concat(F.lit("".join(f"{q}:{a}\n" for q, a in shots)), F.col("q")), client,
                                candidates=5, confidence=0.5).collect()
    assert len(got) == 5 and sum(r.shots == 0 for r in got) == 1 and all(r.shots <= 3 for r in got)
    used = {int(k) for r in got for k in r["keys"]}
    left = [i for i in range(120) if i not in used and i != 13]

    def full(keys):
        shown = [(int(k), "b" if int(k) > 60 else "a") for k in keys]
        return np.mean([(min((abs(v - i), a) for v, a in shown)[1] if shown else "b" if i > 90 else "a") == ("b" if i > 60 else "a") for i in left])
    scores = [full(r["keys"]) for r in got]
    assert scores[0] == max(scores) and got[0].accuracy == pytest.approx(scores[0])
    assert all(r.failed == (1 if r.shots and not r.stopped and 13 not in used else r.failed) for r in got)


def tree_case(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b), int(a + 0.3 * n > 0)) for i, (a, b, n) in enumerate(rng.normal(size=(300, 3)))]
    return spark.createDataFrame(rows, "id long, a double, b double, y int")


@pytest.mark.parametrize("boosted", [False, True])
def test_nodes_give_the_models_own_scores_and_importances(spark, boosted):
    df = tree_case(spark)
    model = fit(gradient_boosting(["a", "b"], "y", rounds=5, depth=3) if boosted else random_forest(["a", "b"], "y", trees=7, depth=4), df)
    nodes = node_table(spark, model)
    both = scored(model, df, ["id"]).join(score_by_nodes(df, nodes, ["a", "b"], ["id"], 4, boosted), "id")
    assert both.count() == 300 and both.filter("abs(probability - by_nodes) > 1e-9").count() == 0
    got = {r.feature: r.importance for r in importances_by_nodes(nodes, boosted).collect()}
    assert all(abs(got.get(i, 0.0) - v) < 1e-6 for i, v in enumerate(model.stages[-1].featureImportances.toArray()))


def test_shapley_values_add_up_and_rank_features(spark):
    df = tree_case(spark)
    model = fit(random_forest(["a", "b"], "y", trees=10, depth=4), df)
    values = shapley_values(model, df, df, ["a", "b"], ["id"], samples=6)
    rows = values.groupBy("id").agg(F.sum("value").alias("s"), F.avg("prediction").alias("p"), F.avg("base").alias("b"))
    assert rows.filter("abs(s - (p - b)) > 1e-9").count() == 0
    assert [r.feature for r in shapley_importances(values).collect()] == ["a", "b"]
    alone = values.filter("feature = 'b'").count()
    assert alone == 300


def test_judge_sees_only_unknown_rows(spark):
    def judge(prompts):
        if any("Given: f" in p for p in prompts):
            raise RuntimeError("down")
        return ["correct." if "Given: c" in p and "how many?" in p else "INCORRECT" for p in prompts]

    df = spark.createDataFrame([("Q1", "how many?", "a", "b", True), ("Q1", "how many?", "a", "c", None), ("Q2", None, "a", "d", None),
                                ("Q1", "how many?", "a", "e", False), ("Q1", "how many?", "a", "f", None)],
                               "question_id string, question string, expected string, answer string, verdict boolean")
    judged = judge_unknown(df, judge)
    assert rows_of(judged, "answer", "verdict", "judge") == [
        ("b", True, "rule"), ("c", True, "model"), ("d", False, "model"), ("e", False, "rule"), ("f", None, "model")]


@pytest.fixture(scope="module")
def points(spark):
    """Two classes, three to one, that one feature separates but for a few rows."""
    x = (F.col("id") % 97) / 97.0
    y = F.when(F.col("id") % 29 == 0, 1).when(x > 0.75, 1).otherwise(0)
    return spark.range(600).select("id", x.alias("a"), ((F.col("id") * 31 % 53) / 53.0).alias("b"), y.cast("int").alias("y")).cache()


def test_split_is_stratified_disjoint_complete_and_repeatable(spark, points):
    train, test = stratified_split(points, "y", ["id"])
    total = dict(rows_of(points.groupBy("y").count(), "y", "count"))
    in_train = dict(rows_of(train.groupBy("y").count(), "y", "count"))
    assert in_train == {y: -(-n * 8 // 10) for y, n in total.items()}
    assert train.join(test, "id", "left_semi").count() == 0 and train.count() + test.count() == 600
    again, _ = stratified_split(points.repartition(7), "y", ["id"])
    assert rows_of(again, "id") == rows_of(train, "id")
    folds = stratified_folds(points, "y", ["id"], 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in folds if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_models_vote_and_registry(spark, points):
    train, test = stratified_split(points, "y", ["id"])
    made = {"lr": logistic_regression(["a", "b"], "y", train.count(), max_iter=50), "rf": random_forest(["a", "b"], "y", trees=10, depth=4),
            "gb": gradient_boosting(["a", "b"], "y", rounds=5, depth=3)}
    models = {n: fit(e, train) for n, e in made.items()}
    vote = soft_vote(models, test)
    off = vote.filter(F.abs(F.col("probability") - (F.col("p_lr") + F.col("p_rf") + F.col("p_gb")) / 3) > 1e-12)
    assert off.count() == 0 and vote.count() == test.count()
    assert vote.filter((F.col("probability") >= 0.5).cast("int") != F.col("prediction")).count() == 0
    assert classification_metrics(vote, "y", "prediction").collect()[0]["f1_score"] > 0.7
    ranked = importances(models, ["a", "b"], test).collect()
    assert ranked[0]["feature"] == "a" and sum(r["importance"] for r in ranked) == pytest.approx(1)
    root = shared_folder(spark, "models")
    assert [register_model(spark, models["rf"], root, "m", r) for r in ("r1", "r2")] == [1, 2]
    assert registered_models(spark, root).count() == 2
    assert rows_of(scored(load_model(spark, root, "m"), test, ["id"]), "id", "probability") == rows_of(
        scored(models["rf"], test, ["id"]), "id", "probability")
    with pytest.raises(ValueError):
        load_model(spark, root, "other")


def test_logistic_regression_scores_in_a_session_that_observed(spark, points):
    seen = Observation()
    points.observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 600}
    model = fit(logistic_regression(["a", "b"], "y", 600, max_iter=20), points)
    both = scored(model, points, ["id"]).join(scored(model, points, ["id"]).withColumnRenamed("prediction", "again"), "id")
    assert both.filter("prediction <> again").count() == 0 and both.count() == 600
    assert soft_vote({"lr": model}, points).count() == 600


def test_cross_validation(spark, points):
    results = cross_validate(random_forest(["a", "b"], "y", trees=5, depth=3), points, "y", ["id"], folds=3).cache()
    assert [r["fold"] for r in results.orderBy("fold").collect()] == [1, 2, 3]
    scores = [r["f1_score"] for r in results.collect()]
    summary = fold_summary(results).collect()[0]
    assert summary["mean_f1"] == pytest.approx(sum(scores) / 3) and summary["std_f1"] >= 0


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.4), (0, 1, 0.8), (0, 0, 0.1)], "y int, p int, s double")
    m = classification_metrics(df, "y", "p").collect()[0]
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (2, 1, 1, 1) and m["accuracy"] == 0.6 and m["f1_score"] == 0.5
    assert rows_of(class_report(df, "y", "p"), "class", "support") == [(0, 3), (1, 2)]
    assert roc_auc(df, "y", "s") == pytest.approx((3 + 1.5) / 6)
    nothing = classification_metrics(df.filter("false"), "y", "p").collect()[0]
    assert nothing["f1_score"] == 0.0 and nothing["accuracy"] == 0.0


def test_run_log(spark):
    runs = run_row(spark, "a", "t1", "lr", {"c": 1}, 0.5, 0.6, 0.7, 3).unionByName(run_row(spark, "b", "t1", "rf", {}, 0.9, 0.6, 0.7, 3))
    best = best_run(runs)
    assert rows_of(best, "run_id") == [("b",)]
    reported = spark.createDataFrame([("t1", 0.95), ("t2", 0.1)], "team string, f1_score double")
    assert rows_of(final_metric(best, reported), "team", "final") == [("t1", 0.95), ("t2", 0.1)]


def test_clinical_features_and_unique_key(spark):
    df = spark.createDataFrame([(1, 60, 250, 140, 150), (2, 55, 250, None, 150)], "id int, age int, chol int, trestbps int, thalach int")
    got = rows_of(clinical_features(df), "hr_reserve", "high_risk", "chol_risk", "age_chol", "bp_hr_ratio")
    assert got == [(10, 1, 1, 15000, 140 / 151), (15, 0, 1, 13750, None)]
    with pytest.raises(ValueError):
        store_features(df.union(df), "never_written", ["id"])


def test_walking_rows_are_never_sent_through_the_driver(spark):
    """Rows times trees grow with the table; only nodes may be broadcast."""
    path = shared_folder(spark, "walk")
    spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"), (F.col("id") % 3 % 2).cast("int").alias("y")).write.parquet(path)
    rows = spark.read.parquet(path)
    model = fit(random_forest(["a", "b"], "y", trees=3, depth=3), rows)
    again = score_by_nodes(rows, node_table(spark, model), ["a", "b"], ["doc_id"], 3, False)
    both = again.join(scored(model, rows, ["doc_id"]), "doc_id").filter(F.abs(F.col("probability") - F.col("by_nodes")) < 1e-9)
    assert both.count() == 400 and again.count() == 400
    plan = spark._jvm.PythonSQLUtils.explainString(again._jdf.queryExecution(), "simple")
    below = [part.split("\n")[1:4] for part in plan.split("BroadcastExchange")[1:]]
    assert below and not any("Generate" in line for lines in below for line in lines)


class Watched:
    """An estimator that notes how many tasks each fit reads its rows with."""

    def __init__(self, estimator):
        self.estimator, self.tasks = estimator, []

    def fit(self, df):
        self.tasks.append(df.rdd.getNumPartitions())
        return self.estimator.fit(df)


def test_fits_have_as_many_tasks_as_their_rows_need(spark):
    estimator = Watched(logistic_regression(["a", "b"], "y", 300))
    fit(estimator, tree_case(spark).repartition(40))
    cross_validate(estimator, tree_case(spark).repartition(40), "y", ["id"])
    assert estimator.tasks == [1] * 6
    many = spark.range(3 * ROWS_A_TASK - 1, numPartitions=1)
    assert spread(many).rdd.getNumPartitions() == 3 and spread(many, 100).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert rows_of(spread(many), "id") == rows_of(many, "id") and spread(many.limit(0)).count() == 0


def test_a_forest_leaves_its_summary_without_being_stored(spark, monkeypatch):
    def stored(*_):
        raise AssertionError("a forest was stored")
    monkeypatch.setattr("shoreline.ml.models.shared_folder", stored)
    model = fit(random_forest(["a", "b"], "y", trees=3, depth=2), tree_case(spark))
    assert not model.stages[-1].hasSummary and scored(model, tree_case(spark), ["id"]).count() == 300


def test_shapley_coalitions_are_scored_by_several_tasks(spark, monkeypatch):
    df, tasks = tree_case(spark).coalesce(1), []
    model = fit(logistic_regression(["a", "b"], "y", 300), df)

    def watched(model, rows, keep):
        tasks.append(rows.rdd.getNumPartitions())
        return scored(model, rows, keep)
    monkeypatch.setattr(shapley, "scored", watched)
    assert shapley_values(model, df, df, ["a", "b"], ["id"], samples=10).count() == 600
    assert tasks == [3]


def test_the_folds_do_not_wait_for_boosting(spark, monkeypatch):
    tested = threading.Event()

    def waiting(estimator, train):
        assert not hasattr(estimator.getStages()[-1], "getStepSize") or tested.wait(120)
        return fit(estimator, train)

    def watched(*given):
        lines = cross_validate(*given)
        tested.set()
        return lines
    monkeypatch.setattr(learning, "random_forest", lambda f, y: random_forest(f, y, trees=3, depth=2))
    monkeypatch.setattr(learning, "gradient_boosting", lambda f, y: gradient_boosting(f, y, rounds=2, depth=2))
    monkeypatch.setattr(learning, "fit", waiting)
    monkeypatch.setattr(learning, "cross_validate", watched)
    df = tree_case(spark)
    done = learning.train_and_register(df, df, ["a", "b"], "y", "id", "t", shared_folder(spark, "beside"))
    assert spark.read.parquet(done["folds"]).count() == 5 and spark.read.parquet(done["runs"]).count() == 3
