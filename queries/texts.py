"""Routing, retrieval, prompts and model calls over tables."""

from pyspark.sql import functions as F

from queries.base import query, table
from queries.fixtures import CLEAN, COHORT, TOPICS, intake_raw, with_views
from queries.sinks import fresh_name
from shoreline.functions.risk import risk_level
from shoreline.operators.model_calls import choose_demonstrations, choose_prompt, rule_client, score_rows
from shoreline.operators.retrieval import nearest, nearest_pruned, text_vectors
from shoreline.operators.routing import (FIRST_MATCH_TOPICS, SCORED_TOPICS, answer_from_metrics, audit_rows, evaluation_counts,
                                         first_topic, guard, mentions_of_top, topic_by_score, topic_sections)
from shoreline.plans.briefing import cohort_prompt, executive_briefing, metric_answers, risk_prompt
from shoreline.plans.medallion import clean, rollup
from shoreline.session import shared_folder
from shoreline.sinks.tables import append_rows, create_table_if_absent


def any_like(words):
    return "(" + " OR ".join(f"LOWER(text) LIKE '%{w}%'" for w in words) + ")"


def hits(words):
    return "(" + " + ".join(f"CASE WHEN CONTAINS(LOWER(text), '{w}') THEN 1 ELSE 0 END" for w in words) + ")"


@query("txt_01_first_topic", with_views("routed", "SELECT conv_id, turn, topic FROM routed"))
def first(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", first_topic(F.col("text"), TOPICS).alias("topic"))


@query("txt_01_first_topic_default", "SELECT doc_id, CASE " + " ".join(
    f"WHEN {any_like(words)} THEN '{topic}'" for topic, words in FIRST_MATCH_TOPICS.items())
    + " ELSE 'other' END AS topic FROM documents")
def first_default(spark, sf):
    return table(spark, sf, "documents").select("doc_id", first_topic(F.col("text")).alias("topic"))


@query("txt_02_all_topics", "WITH hit AS (" + " UNION ALL ".join(
    f"SELECT conv_id, turn, '{topic}' AS topic FROM conversations WHERE {any_like(words)}" for topic, words in TOPICS.items())
    + """) SELECT * FROM hit UNION ALL SELECT conv_id, turn, 'help' FROM conversations c
    WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.conv_id = c.conv_id AND h.turn = c.turn)""")
def sections(spark, sf):
    return topic_sections(table(spark, sf, "conversations"), "text", TOPICS).select("conv_id", "turn", "topic")


PAIR = {"left": ["the", "and", "tion"], "right": ["eau", "que", "ment"]}


@query("txt_03_topic_by_score", f"""
    SELECT conv_id, turn, CASE WHEN {hits(PAIR['left'])} > {hits(PAIR['right'])} THEN 'left'
           WHEN {hits(PAIR['right'])} > {hits(PAIR['left'])} THEN 'right' ELSE 'both' END AS topic FROM conversations""")
def by_score(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", topic_by_score(F.col("text"), PAIR).alias("topic"))


@query("txt_03_topic_by_score_default", f"""
    SELECT doc_id, CASE WHEN {hits(SCORED_TOPICS['clinical'])} > {hits(SCORED_TOPICS['pharmacy'])} THEN 'clinical'
           WHEN {hits(SCORED_TOPICS['pharmacy'])} > {hits(SCORED_TOPICS['clinical'])} THEN 'pharmacy' ELSE 'both' END AS topic FROM documents""")
def by_score_default(spark, sf):
    return table(spark, sf, "documents").select("doc_id", topic_by_score(F.col("text")).alias("topic"))


def routed(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", "text", first_topic(F.col("text"), TOPICS).alias("topic"))


def answers(spark, sf):
    count = F.count("*").alias("n")
    sentence = lambda what: F.concat(F.lit("There are "), F.col("n").cast("string"), F.lit(f" {what}"))
    metrics = {t: (table(spark, sf, source).agg(count), sentence(source), source)
               for t, source in (("a", "events"), ("b", "orders"), ("c", "customer"))}
    return answer_from_metrics(routed(spark, sf), metric_answers(metrics))


ANSWERED = """SELECT conv_id, turn, topic, CASE topic
    WHEN 'a' THEN 'There are ' || (SELECT COUNT(*) FROM events) || ' events (source: events)'
    WHEN 'b' THEN 'There are ' || (SELECT COUNT(*) FROM orders) || ' orders (source: orders)'
    WHEN 'c' THEN 'There are ' || (SELECT COUNT(*) FROM customer) || ' customer (source: customer)'
    ELSE 'Please ask about one of the known topics.' END AS answer FROM routed"""


@query("txt_04_answer_from_metrics", with_views("routed", ANSWERED))
def answered(spark, sf):
    return answers(spark, sf).select("conv_id", "turn", "topic", "answer")


@query("txt_05_audit_log", with_views("routed", f"""
    SELECT answer, CASE WHEN topic = 'other' THEN 'off topic' ELSE 'answered' END AS status, COUNT(*) AS n_rows
    FROM ({ANSWERED}) GROUP BY 1, 2"""))
def audit(spark, sf):
    path = shared_folder(spark, "audit")
    name = fresh_name("audit", path)
    create_table_if_absent(spark, name, {"question": "string", "answer": "string", "status": "string"}, path)
    status = F.when(F.col("topic") == "other", "off topic").otherwise("answered")
    append_rows(audit_rows(answers(spark, sf).withColumn("status", status), "text", "answer", "status"), name)
    return spark.table(name).groupBy("answer", "status").agg(F.count("*").alias("n_rows"))


@query("txt_06_guard", f"""
    SELECT conv_id, turn, {any_like(['ment', 'ung'])} AS is_advice, {hits(['the', 'eau', 'ung'])} = 0 AS is_off_topic,
           ROUND({hits(['the', 'eau', 'ung'])} / 3.0::DOUBLE, 6) AS confidence,
           CASE WHEN {any_like(['ment', 'ung'])} THEN 'refused' WHEN {hits(['the', 'eau', 'ung'])} = 0 THEN 'off topic'
                ELSE 'answered' END AS status,
           CASE WHEN {any_like(['ment', 'ung'])} THEN 'I cannot provide medical advice.' END AS reply FROM conversations""")
def guarded(spark, sf):
    rows = guard(table(spark, sf, "conversations"), "text", TOPICS, ["ment", "ung"])
    return rows.select("conv_id", "turn", "is_advice", "is_off_topic", F.round("confidence", 6).alias("confidence"),
                       "status", "reply")


@query("txt_07_evaluation", """
    SELECT CASE WHEN REGEXP_MATCHES(text, '[0-9]') THEN 'PASS' ELSE 'WEAK' END AS evaluation, COUNT(*) AS "rows"
    FROM documents GROUP BY 1""")
def evaluation(spark, sf):
    return evaluation_counts(table(spark, sf, "documents"), "text")


def centroids(spark, sf):
    """Mean vector per label: the questions put to the whole collection."""
    parts = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("at", "x"))
    means = parts.groupBy("label", "at").agg(F.avg(F.col("x").cast("double")).alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "m")))
    return means.groupBy("label").agg(F.transform(ordered, lambda p: p["m"]).alias("embedding")).withColumnRenamed("label", "query_label")


@query("txt_08_nearest_vectors", """
    WITH means AS (SELECT label AS query_label, LIST(m ORDER BY i) AS q FROM (
             SELECT label, i, AVG(x::DOUBLE) AS m FROM (
                 SELECT label, UNNEST(embedding) AS x, GENERATE_SUBSCRIPTS(embedding, 1) AS i FROM embeddings) GROUP BY label, i) GROUP BY label),
         scored AS (SELECT query_label, vec_id, label, ROUND(LIST_COSINE_SIMILARITY(embedding::DOUBLE[], q), 6) AS score
                    FROM embeddings, means)
    SELECT query_label, vec_id, label, score, rank FROM (
        SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_label ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored) WHERE rank <= 3""")
def nearest_vectors(spark, sf):
    return nearest(table(spark, sf, "embeddings"), centroids(spark, sf), 3, "vec_id", "embedding", "query_label", ["label"])


@query("txt_08_pruned_search", """
    WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
         scored AS (SELECT a.vec_id AS query_vec, b.vec_id, ROUND(LIST_COSINE_SIMILARITY(a.v, b.v), 6) AS score FROM v a, v b),
         top AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_vec ORDER BY score DESC, vec_id) AS rank FROM scored)
    SELECT query_vec, vec_id, score, CAST(rank AS INT) AS rank, TRUE AS looked_at_no_more_than_all FROM top WHERE rank <= 3""")
def pruned_search(spark, sf):
    """Every vector asks; clusters that cannot hold a result are skipped."""
    vectors = table(spark, sf, "embeddings")
    found = nearest_pruned(vectors, vectors.withColumnRenamed("vec_id", "query_vec"), 3, "vec_id", "embedding", "query_vec")
    return found.select("query_vec", "vec_id", "score", "rank", (F.col("looked_at") <= vectors.agg(F.count("*")).scalar()).alias("looked_at_no_more_than_all"))


@query("txt_08_text_search", """
    SELECT item_id, 3::BIGINT AS hits, TRUE AS ranked, TRUE AS scores_in_range FROM benchmark""")
def text_search(spark, sf):
    documents, questions = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    docs, asked = text_vectors(documents, [documents, questions], "text")
    found = nearest(docs, asked, 3, "doc_id", "embedding", "item_id", ["lang", "source"])
    return found.groupBy("item_id").agg(
        F.count_distinct("doc_id").alias("hits"), (F.array_sort(F.collect_list("rank")) == F.expr("array(1, 2, 3)")).alias("ranked"),
        F.bool_and(F.col("score").between(-1, 1.000001)).alias("scores_in_range"))


@query("txt_09_prompt_column", with_views("gold", """
    SELECT value_group, outcome, 'You are an analyst. Describe this cohort: group=' || value_group || ', outcome=' || outcome
           || ', n=' || event_count AS prompt FROM gold"""))
def prompts(spark, sf):
    gold = rollup(clean(intake_raw(spark, sf), CLEAN), COHORT)
    return gold.select("value_group", "outcome", cohort_prompt(
        "You are an analyst. Describe this cohort:", group=F.col("value_group"), outcome=F.col("outcome"),
        n=F.col("event_count")).alias("prompt"))


VITALS_SQL = """SELECT l_orderkey, l_linenumber, l_quantity + 25 AS age, 150.0 + l_partkey % 150 AS chol, 100.0 + l_suppkey % 80 AS bp,
                       60.0 + l_linenumber * 12 AS hr FROM lineitem"""
RISK_SQL = """CASE WHEN age > 60 AND (chol > 250 OR bp > 150) THEN 'HIGH'
    WHEN age BETWEEN 45 AND 60 AND (CASE WHEN chol > 200 THEN 1 ELSE 0 END) + (CASE WHEN bp > 130 THEN 1 ELSE 0 END)
         + (CASE WHEN hr > 100 THEN 1 ELSE 0 END) >= 2 THEN 'MEDIUM' ELSE 'LOW' END"""


def vitals(spark, sf):
    """Line items read as measures of the risk rule."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") + 25).alias("age"),
        (F.lit(150.0) + F.col("l_partkey") % 150).alias("chol"), (F.lit(100.0) + F.col("l_suppkey") % 80).alias("bp"),
        (F.lit(60.0) + F.col("l_linenumber") * 12).alias("hr"))


@query("txt_10_model_call", f"SELECT l_orderkey, l_linenumber, {RISK_SQL} AS risk FROM ({VITALS_SQL})")
def model_call(spark, sf):
    rows = vitals(spark, sf).withColumn("prompt", risk_prompt(*[F.col(c) for c in ("age", "chol", "bp", "hr")]))
    return score_rows(rows, "prompt", rule_client(), output="risk").select("l_orderkey", "l_linenumber", "risk")


@query("txt_11_risk_rule", f"SELECT l_orderkey, l_linenumber, {RISK_SQL} AS risk FROM ({VITALS_SQL})")
def risk(spark, sf):
    return vitals(spark, sf).select("l_orderkey", "l_linenumber", risk_level(
        *[F.col(c) for c in ("age", "chol", "bp", "hr")]).alias("risk"))


@query("txt_12_briefing", """
    SELECT team, 'Analysed ' || total_rows || ' events; ' || prevalence_pct || '% failed.' AS briefing_text, total_rows, prevalence_pct
    FROM (SELECT 'alpha' AS team, COUNT(*) AS total_rows,
                 ROUND(COUNT(*) FILTER (WHERE event_type = 'error') * 100.0 / COUNT(*)::DOUBLE, 6) AS prevalence_pct FROM events)""")
def briefing(spark, sf):
    return executive_briefing(table(spark, sf, "events"), F.col("event_type") == "error", "alpha",
                              "Analysed %s events; %s%% failed.", digits=6).drop("generated_at")


@query("txt_13_choose_prompt", f"""
    WITH v AS (SELECT *, {RISK_SQL} AS label FROM ({VITALS_SQL})),
         w AS (SELECT label, {RISK_SQL} AS reply FROM (SELECT label, age, chol, hr, -1.0 AS bp FROM v))
    SELECT 'full' AS candidate, COUNT(*) AS examples, 0::BIGINT AS failed, 1.0::DOUBLE AS accuracy FROM v
    UNION ALL SELECT 'without_bp', COUNT(*), 0, ROUND(AVG(CASE WHEN label = reply THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) FROM w""")
def prompt_choice(spark, sf):
    age, chol, bp, hr = (F.col(c) for c in ("age", "chol", "bp", "hr"))
    rows = vitals(spark, sf).withColumn("label", F.concat(F.lit(" "), F.lower(risk_level(age, chol, bp, hr))))
    return choose_prompt(rows, {"full": risk_prompt(age, chol, bp, hr), "without_bp": risk_prompt(age, chol, F.lit("none"), hr)},
                         "label", rule_client()).withColumn("accuracy", F.round("accuracy", 6))


def nearest_shot_client(prompts):
    """A model that goes by the demonstration with the nearest number; without any it knows the outer ranges only."""
    answers = []
    for p in prompts:
        *shown, asked = p.split("\n")
        value = float(asked.split()[0])
        pairs = [(abs(float(line.split()[0]) - value), line.split()[2]) for line in shown]
        answers.append(min(pairs)[1] if pairs else "high" if value > 40 else "low")
    return answers


@query("txt_13_demonstrations", """
    SELECT 6::BIGINT AS candidates, TRUE AS demonstrations_are_right, TRUE AS winner_is_best, TRUE AS better_than_none FROM (SELECT 1)
    WHERE (SELECT COUNT(*) FROM lineitem) > 0""")
def demonstrations(spark, sf):
    """The winner of the early-stopped comparison beside every set's accuracy on all rows."""
    rows = table(spark, sf, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_quantity").alias("id"), F.col("l_quantity").cast("string").alias("size"),
                                               F.when(F.col("l_quantity") > 25, "high").otherwise("low").alias("label"))
    chosen = choose_demonstrations(rows, "size", "label", "id", lambda shots: F.concat(
        F.lit("".join(f"{q} -> {a}\n" for q, a in shots)), F.col("size"), F.lit(" -> ")), nearest_shot_client).collect()
    values = {r["id"]: (float(r["size"]), r["label"]) for r in rows.filter(F.col("id").isin([k for c in chosen for k in c["keys"]])).collect()}

    def answer(keys):
        value, shown = F.col("size").cast("double"), [values[k] for k in keys]
        if not shown:
            return F.when(value > 40, "high").otherwise("low")
        return F.array_min(F.array(*[F.struct(F.abs(value - v).alias("apart"), F.lit(a).alias("label")) for v, a in shown]))["label"]
    right = rows.agg(*[F.avg((answer(c["keys"]) == F.col("label")).cast("double")) for c in chosen]).collect()[0]
    return rows.limit(1).select(
        F.lit(len(chosen)).cast("long").alias("candidates"), F.lit(all(a == ("high" if v > 40 else "low") for v, a in values.values())).alias("demonstrations_are_right"),
        F.lit(right[0] >= max(right) - 0.01).alias("winner_is_best"), F.lit(right[0] >= right[[c["shots"] for c in chosen].index(0)]).alias("better_than_none"))


@query("txt_14_mentions_of_top", """
    WITH top AS (SELECT lang FROM documents GROUP BY lang ORDER BY COUNT(*) DESC, lang LIMIT 1)
    SELECT source, lang AS mentioned, COUNT(*) AS documents FROM (SELECT d.source, d.text, top.lang FROM documents d, top)
    WHERE CONTAINS(LOWER(text), lang) GROUP BY source, lang""")
def mentions(spark, sf):
    documents = table(spark, sf, "documents")
    return mentions_of_top(documents, "lang", documents, "text", "source")
