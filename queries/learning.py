"""Machine learning on tables. Model queries return what SQL can state of a fit: rows, ranges and sums."""

from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import clinical, with_views
from shoreline.ml.features import clinical_features, feature_table, fill_missing, over, per_plus_one
from shoreline.ml.metrics import class_report, classification_metrics, roc_auc
from shoreline.ml.models import (BOOSTED, FOREST, LOGISTIC, cross_validate, fit, gradient_boosting, importances,
                                 logistic_regression, permutation_importances, random_forest, scored, soft_vote)
from shoreline.ml.registry import best_run, final_metric, load_model, register_model, registered_models
from shoreline.ml.shapley import shapley_values
from shoreline.ml.split import mark_split, stratified_folds
from shoreline.ml.trees import importances_by_nodes, node_table, score_by_nodes
from shoreline.operators.joins import feature_lookup
from shoreline.plans.learning import train_and_register
from shoreline.session import shared_folder

FEATURES = ["n_chars", "blanks", "lines", "chars_per_word", "lines_per_word", "is_long", "word_lines"]
TEST_ROWS = "(SELECT SUM(n - CAST(CEIL(n * 0.8::DOUBLE) AS BIGINT))::BIGINT AS n FROM (SELECT quality, COUNT(*) AS n FROM labels GROUP BY quality))"


def document_features(spark, sf):
    text = F.col("text")

    def occurrences(what):
        return (F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))).cast("long")

    base = table(spark, sf, "documents").select(
        "doc_id", "n_chars", occurrences(" ").alias("blanks"), occurrences("\n").alias("lines"))
    return feature_table(base, "doc_id", {
        "chars_per_word": per_plus_one(F.col("n_chars"), F.col("blanks")),
        "lines_per_word": per_plus_one(F.col("lines"), F.col("blanks")),
        "is_long": over(F.col("n_chars"), 2000),
        "word_lines": F.col("blanks") * F.col("lines")}, keep=["n_chars", "blanks", "lines"])


def examples(spark, sf):
    """Labelled documents with their features."""
    joined = feature_lookup(table(spark, sf, "labels").select("doc_id", "quality"), document_features(spark, sf), ["doc_id"])
    return fill_missing(joined, FEATURES)


def estimators(rows):
    return {LOGISTIC: logistic_regression(FEATURES, "quality", rows),
            FOREST: random_forest(FEATURES, "quality"),
            BOOSTED: gradient_boosting(FEATURES, "quality")}


@query("ml_01_feature_table", r"""
    WITH base AS (SELECT doc_id, n_chars, LENGTH(text) - LENGTH(REPLACE(text, ' ', '')) AS blanks,
                         LENGTH(text) - LENGTH(REPLACE(text, CHR(10), '')) AS lines FROM documents)
    SELECT doc_id, n_chars, blanks, lines, n_chars / (blanks + 1)::DOUBLE AS chars_per_word,
           lines / (blanks + 1)::DOUBLE AS lines_per_word, CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END AS is_long,
           blanks * lines AS word_lines FROM base""")
def features(spark, sf):
    return document_features(spark, sf)


@query("ml_01_clinical_features", with_views("clinical", """
    SELECT *, 220 - age - thalach AS hr_reserve, CASE WHEN age > 55 AND chol > 240 THEN 1 ELSE 0 END AS high_risk,
           CASE WHEN chol > 240 THEN 1 ELSE 0 END AS chol_risk, age * chol AS age_chol,
           trestbps / (thalach + 1)::DOUBLE AS bp_hr_ratio FROM clinical"""))
def patient_features(spark, sf):
    return clinical_features(clinical(spark, sf))


@query("ml_02_stratified_split", """
    SELECT quality, s.is_train, CASE WHEN s.is_train THEN CAST(CEIL(n * 0.8::DOUBLE) AS BIGINT) ELSE n - CAST(CEIL(n * 0.8::DOUBLE) AS BIGINT) END AS n_rows
    FROM (SELECT quality, COUNT(*) AS n FROM labels GROUP BY quality), (VALUES (TRUE), (FALSE)) AS s(is_train)""")
def split(spark, sf):
    return mark_split(table(spark, sf, "labels"), "quality", ["doc_id"]).groupBy("quality", "is_train").agg(
        F.count("*").alias("n_rows"))


#: Stored splits and fits of this session, so that entries over the same table share them.
SPLITS: dict[tuple[str, str], str] = {}
MODELS: dict[tuple[str, str, str], object] = {}


def split_once(spark, sf):
    """Training and test rows, marked once and stored, as every fit and every test reads them."""
    here = (spark.sparkContext.applicationId, sf)
    if here not in SPLITS:
        path = shared_folder(spark, "split")
        mark_split(examples(spark, sf), "quality", ["doc_id"]).write.parquet(path)
        SPLITS[here] = path
    marked = spark.read.parquet(SPLITS[here])
    return marked.filter("is_train").drop("is_train"), marked.filter("NOT is_train").drop("is_train")


def outside(*probabilities):
    """Rows with a probability out of range."""
    bad = F.lit(False)
    for p in probabilities:
        bad = bad | ~F.coalesce(F.col(p).between(0, 1), F.lit(False))
    return F.count_if(bad).alias("out_of_range")


def single_feature_auc(rows):
    """The best AUC that one feature reaches alone, whichever way it points."""
    areas = [roc_auc(rows.select(F.col("quality"), F.col(f).cast("double").alias("probability")), "quality", "probability") for f in FEATURES]
    return max(max(a, 1 - a) for a in areas)


def stationary(model, train):
    """Whether the gradient of the penalised loss is near zero at the fitted weights, computed from the rows."""
    scaler, logit = model.stages[-2], model.stages[-1]
    weights, size = [float(w) for w in logit.coefficients], train.count()
    z = [(F.col(f).cast("double") - float(m)) / float(s or 1.0) for f, m, s in zip(FEATURES, scaler.mean, scaler.std)]
    total = F.lit(float(logit.intercept))
    for w, x in zip(weights, z):
        total = total + w * x
    error = 1 / (1 + F.exp(-total)) - F.col("quality")
    slopes = train.agg(F.avg(error), *[F.avg(error * x) for x in z]).collect()[0]
    penalty = logit.getRegParam()
    return abs(slopes[0]) < 1e-4 and all(abs(g + penalty * w) < 1e-4 for g, w in zip(slopes[1:], weights)) and size > 0


@query("ml_03_logistic_regression", f"SELECT n AS n_rows, 0::BIGINT AS out_of_range, TRUE AS stationary, TRUE AS better_than_none FROM {TEST_ROWS}")
def logistic(spark, sf):
    """The optimum has no slope, and a smaller loss than the best constant."""
    models, test = fitted(spark, sf, (LOGISTIC,))
    train, _ = split_once(spark, sf)
    p, y = F.col("probability"), F.col("quality")
    loss = F.avg(-F.log(F.when(y == 1, p).otherwise(1 - p)))
    share = F.avg(y.cast("double"))
    known = scored(models[LOGISTIC], train, ["quality"]).agg(loss.alias("l"), (-share * F.log(share) - (1 - share) * F.log(1 - share)).alias("c")).collect()[0]
    return scored(models[LOGISTIC], test, ["doc_id"]).agg(F.count("*").alias("n_rows"), outside("probability"), F.lit(stationary(models[LOGISTIC], train)).alias("stationary"),
                                                         F.lit(known["l"] < known["c"] - 0.01).alias("better_than_none"))


TREE_SQL = f"SELECT n AS n_rows, 0::BIGINT AS off_the_nodes, TRUE AS above_single_features FROM {TEST_ROWS}"


def tree_row(spark, sf, name, depth):
    """Test rows scored again from the stored nodes, and the fit's AUC on its own rows beside single features."""
    models, test = fitted(spark, sf, (name,))
    train, _ = split_once(spark, sf)
    nodes = node_table(spark, models[name])
    again = score_by_nodes(test, nodes, FEATURES, ["doc_id"], depth, boosted=name == BOOSTED)
    both = scored(models[name], test, ["doc_id"]).join(again, "doc_id", "left")
    off = F.count_if(~F.coalesce(F.abs(F.col("probability") - F.col("by_nodes")) < 1e-9, F.lit(False)))
    area = roc_auc(scored(models[name], train, ["quality"]), "quality", "probability")
    return both.agg(F.count("*").alias("n_rows"), off.alias("off_the_nodes"), F.lit(area > single_feature_auc(train)).alias("above_single_features"))


@query("ml_04_random_forest", TREE_SQL)
def forest(spark, sf):
    return tree_row(spark, sf, FOREST, 10)


@query("ml_05_gradient_boosting", TREE_SQL)
def boosting(spark, sf):
    return tree_row(spark, sf, BOOSTED, 5)


def fitted(spark, sf, names=(LOGISTIC, FOREST, BOOSTED)):
    train, test = split_once(spark, sf)
    made = estimators(train.count())
    for n in names:
        here = (spark.sparkContext.applicationId, sf, n)
        if here not in MODELS:
            MODELS[here] = fit(made[n], train)
    return {n: MODELS[(spark.sparkContext.applicationId, sf, n)] for n in names}, test


@query("ml_06_soft_vote", f"SELECT n AS n_rows, 0::BIGINT AS out_of_range, 0::BIGINT AS off_the_mean, 0::BIGINT AS off_the_cut FROM {TEST_ROWS}")
def vote(spark, sf):
    models, test = fitted(spark, sf)
    rows, members = soft_vote(models, test), [f"p_{n}" for n in models]
    mean = sum((F.col(m) for m in members), F.lit(0.0)) / len(members)
    return rows.agg(F.count("*").alias("n_rows"), outside("probability", *members),
                    F.count_if(F.abs(F.col("probability") - mean) > 1e-9).alias("off_the_mean"),
                    F.count_if((F.col("probability") >= 0.5).cast("int") != F.col("prediction")).alias("off_the_cut"))


@query("ml_07_cross_validation", """
    SELECT CAST(f.fold AS INT) AS fold, SUM((CAST(CEIL(n * 0.8::DOUBLE) AS BIGINT) + 5 - f.fold) // 5)::BIGINT AS n_rows, TRUE AS better_than_chance
    FROM (SELECT quality, COUNT(*) AS n FROM labels GROUP BY quality), (VALUES (1), (2), (3), (4), (5)) AS f(fold) GROUP BY f.fold""")
def folds(spark, sf):
    """Rows tested per fold; over all folds, rows are ranked better than by chance by models that have not seen them."""
    train, _ = split_once(spark, sf)
    lines = cross_validate(random_forest(FEATURES, "quality"), train, "quality", ["doc_id"])
    chance = lines.agg(F.sum(F.col("roc_auc") * F.col("rows")) / F.sum("rows")).scalar()
    return lines.select("fold", F.col("rows").alias("n_rows"), (chance > 0.6).alias("better_than_chance"))


@query("ml_07_stratified_folds", """
    SELECT quality, CAST(f.fold AS INT) AS fold, (n + 4 - f.fold) // 5 AS n_rows
    FROM (SELECT quality, COUNT(*) AS n FROM labels GROUP BY quality), (VALUES (0), (1), (2), (3), (4)) AS f(fold)""")
def fold_sizes(spark, sf):
    return stratified_folds(table(spark, sf, "labels"), "quality", ["doc_id"]).groupBy("quality", "fold").agg(
        F.count("*").alias("n_rows"))


def given_predictions(spark, sf):
    """Line items as labels and scores: returned or not, by quantity."""
    return table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), (F.col("l_quantity") / 50).alias("probability"),
        (F.col("l_quantity") >= 25).cast("int").alias("prediction"))


@query("ml_08_metrics", """
    WITH p AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity AS q,
                      CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS z FROM lineitem),
         c AS (SELECT COUNT(*) FILTER (WHERE y = 0 AND z = 0) AS tn, COUNT(*) FILTER (WHERE y = 0 AND z = 1) AS fp,
                      COUNT(*) FILTER (WHERE y = 1 AND z = 0) AS fn, COUNT(*) FILTER (WHERE y = 1 AND z = 1) AS tp FROM p),
         s AS (SELECT q, SUM(y)::DOUBLE AS pos, SUM(1 - y)::DOUBLE AS neg FROM p GROUP BY q),
         r AS (SELECT pos, neg, SUM(neg) OVER (ORDER BY q) - neg AS below FROM s)
    SELECT tn, fp, fn, tp, ROUND((tp + tn) / (tn + fp + fn + tp)::DOUBLE, 6) AS accuracy,
           ROUND(tp / (tp + fp)::DOUBLE, 6) AS precision, ROUND(tp / (tp + fn)::DOUBLE, 6) AS recall,
           ROUND(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS f1_score,
           (SELECT ROUND(SUM(pos * (below + neg / 2)) / (SUM(pos) * SUM(neg)), 6) FROM r) AS roc_auc FROM c""")
def metrics(spark, sf):
    rows = given_predictions(spark, sf)
    result = classification_metrics(rows, "label", "prediction").withColumn(
        "roc_auc", F.lit(roc_auc(rows, "label", "probability")))
    return result.select("tn", "fp", "fn", "tp", *[F.round(c, 6).alias(c) for c in (
        "accuracy", "precision", "recall", "f1_score", "roc_auc")])


@query("ml_08_class_report", """
    WITH p AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS z FROM lineitem)
    SELECT c.k AS class, ROUND(COUNT(*) FILTER (WHERE y = c.k AND z = c.k) / COUNT(*) FILTER (WHERE z = c.k)::DOUBLE, 6) AS precision,
           ROUND(COUNT(*) FILTER (WHERE y = c.k AND z = c.k) / COUNT(*) FILTER (WHERE y = c.k)::DOUBLE, 6) AS recall,
           ROUND(2 * COUNT(*) FILTER (WHERE y = c.k AND z = c.k) / (COUNT(*) FILTER (WHERE z = c.k) + COUNT(*) FILTER (WHERE y = c.k))::DOUBLE, 6) AS f1_score,
           COUNT(*) FILTER (WHERE y = c.k) AS support FROM p, (VALUES (0), (1)) AS c(k) GROUP BY c.k""")
def report(spark, sf):
    lines = class_report(given_predictions(spark, sf), "label", "prediction")
    return lines.select("class", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_score")])


@query("ml_09_feature_importance", "SELECT 7::BIGINT AS features, 0::BIGINT AS off_the_nodes, 1.0::DOUBLE AS total")
def importance(spark, sf):
    """Importances beside those that follow from the stored nodes of both ensembles."""
    models, test = fitted(spark, sf, (FOREST, BOOSTED))
    names = F.array(*[F.lit(f) for f in FEATURES])
    parts = [importances_by_nodes(node_table(spark, models[n]), n == BOOSTED) for n in (FOREST, BOOSTED)]
    mean = parts[0].unionByName(parts[1]).groupBy(F.get(names, F.col("feature")).alias("feature")).agg((F.sum("importance") / 2).alias("by_nodes"))
    both = importances(models, FEATURES, test).join(mean, "feature", "left")
    off = F.abs(F.col("importance") - F.coalesce("by_nodes", F.lit(0.0))) > 1e-6
    return both.agg(F.count("*").alias("features"), F.count_if(off).alias("off_the_nodes"), F.round(F.sum("by_nodes"), 6).alias("total"))


@query("ml_09_permutation_importance", "SELECT 7::BIGINT AS features, TRUE AS best_counts, TRUE AS worst_is_small")
def shuffled_importance(spark, sf):
    """Shuffling the best feature costs ranking quality; the least used one costs next to none."""
    models, _ = fitted(spark, sf, (FOREST,))
    train, _ = split_once(spark, sf)
    lines = permutation_importances(models[FOREST], train, FEATURES, "quality", ["doc_id"])
    return lines.agg(F.count("*").alias("features"), (F.max("importance") > 0.005).alias("best_counts"),
                     (F.min("importance") < F.max("importance") / 2).alias("worst_is_small"))


@query("ml_09_shapley", f"SELECT n AS n_rows, 7::BIGINT AS features, 0::BIGINT AS off_the_sum, TRUE AS some_feature_counts FROM {TEST_ROWS}")
def shapley(spark, sf):
    """Every row's values add up to its probability less the base; together they are not nothing."""
    models, test = fitted(spark, sf, (FOREST,))
    train, _ = split_once(spark, sf)
    values = shapley_values(models[FOREST], test, train, FEATURES, ["doc_id"])
    rows = values.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("value").alias("sum"), F.avg("prediction").alias("p"), F.avg("base").alias("b"), F.max(F.abs("value")).alias("top"))
    known = rows.join(scored(models[FOREST], test, ["doc_id"]), "doc_id")
    off = (F.abs(F.col("sum") - (F.col("p") - F.col("b"))) > 1e-6) | (F.abs(F.col("p") - F.col("probability")) > 1e-6)
    return known.agg(F.count("*").alias("n_rows"), F.max("n").alias("features"), F.count_if(off).alias("off_the_sum"), (F.max("top") > 0.01).alias("some_feature_counts"))


def runs(spark, sf):
    """Events as runs: the value is the metric, the type the model."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("run_id"), F.col("user_id").alias("team"), F.col("event_type").alias("model_type"),
        F.round(F.col("value") / 500, 6).alias("f1_score"))


@query("ml_10_best_run", """
    SELECT run_id, team, model_type, f1_score FROM (
        SELECT event_id AS run_id, user_id AS team, event_type AS model_type, ROUND(value / 500, 6) AS f1_score,
               ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ROUND(value / 500, 6) DESC, event_id) AS rn FROM events) WHERE rn = 1""")
def best(spark, sf):
    return best_run(runs(spark, sf))


@query("ml_10_final_metric", """
    SELECT COALESCE(b.team, r.team) AS team, b.logged, r.reported, GREATEST(b.logged, r.reported) AS final
    FROM (SELECT user_id AS team, MAX(ROUND(value / 500, 6)) AS logged FROM events GROUP BY user_id) b
    FULL JOIN (SELECT s_suppkey AS team, MAX(ROUND(s_acctbal / 10000, 6)) AS reported FROM supplier GROUP BY s_suppkey) r
    ON b.team = r.team""")
def final(spark, sf):
    reported = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("team"), F.round(F.col("s_acctbal") / 10000, 6).alias("f1_score"))
    return final_metric(best_run(runs(spark, sf)), reported)


@query("ml_11_model_registry", "SELECT 2 AS versions, 0::BIGINT AS changed_predictions, COUNT(*) AS n_rows FROM labels")
def registry(spark, sf):
    rows = examples(spark, sf)
    model = fit(logistic_regression(FEATURES, "quality", rows.count()), rows)
    root = shared_folder(spark, "models")
    for run in ("first", "second"):
        register_model(spark, model, root, "document_quality", run)
    again = load_model(spark, root, "document_quality", 2)
    before = scored(model, rows, ["doc_id"])
    after = scored(again, rows, ["doc_id"]).withColumnRenamed("prediction", "reloaded").drop("probability")
    versions = registered_models(spark, root).agg(F.max("version")).scalar()
    return before.join(after, "doc_id").agg(
        F.count_if(F.col("prediction") != F.col("reloaded")).alias("changed_predictions"), F.count("*").alias("n_rows")
    ).withColumn("versions", versions)


@query("ml_12_batch_scoring", "SELECT COUNT(*) AS n_rows, 0::BIGINT AS out_of_range FROM documents")
def batch(spark, sf):
    models, _ = fitted(spark, sf, (LOGISTIC,))
    everything = fill_missing(document_features(spark, sf), FEATURES)
    return scored(models[LOGISTIC], everything, ["doc_id"]).agg(F.count("*").alias("n_rows"), outside("probability"))


@query("ml_00_learning_job", f"""
    SELECT 'alpha' AS team, 7 AS n_features, TRUE AS best_of_all, TRUE AS in_range, 3::BIGINT AS runs, 5::BIGINT AS folds, 1 AS version,
           (SELECT COUNT(*) FROM documents) AS scored_rows""")
def learning_job(spark, sf):
    root = shared_folder(spark, "learning")
    everything = fill_missing(document_features(spark, sf), FEATURES)
    done = train_and_register(examples(spark, sf), everything, FEATURES, "quality", "doc_id", "alpha", root)
    runs, result = spark.read.parquet(done["runs"]), spark.read.parquet(done["result"])
    top = runs.agg(F.max("f1_score")).scalar()
    return result.select(
        "team", "n_features", (F.col("f1_score") == top).alias("best_of_all"),
        (F.col("f1_score").between(0, 1) & F.col("roc_auc").between(0, 1) & F.col("accuracy").between(0, 1)).alias("in_range"),
        runs.agg(F.count("*")).scalar().alias("runs"), spark.read.parquet(done["folds"]).agg(F.count("*")).scalar().alias("folds"),
        F.lit(done["version"]).alias("version"), spark.read.parquet(done["scores"]).agg(F.count("*")).scalar().alias("scored_rows"))
