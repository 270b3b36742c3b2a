"""SQL functions and model functions."""

import os

from pyspark.sql import functions as F

from queries.base import query
from queries.fixtures import CLEAN, COHORT, intake_raw, with_views
from queries.texts import RISK_SQL, VITALS_SQL, vitals
from shoreline.functions.risk import register_cohort_summary, register_risk_function
from shoreline.operators.model_calls import rule_client, score_rows
from shoreline.plans.briefing import risk_prompt
from shoreline.plans.medallion import clean, rollup
from shoreline.session import shared_folder


@query("udf_01_sql_function", f"SELECT l_orderkey, l_linenumber, {RISK_SQL} AS risk FROM ({VITALS_SQL})")
def sql_function(spark, sf):
    name = register_risk_function(spark)
    return vitals(spark, sf).select("l_orderkey", "l_linenumber", F.expr(f"{name}(age, chol, bp, hr)").alias("risk"))


@query("udf_02_table_function", with_views("gold", """
    SELECT value_group, outcome, 'Group: ' || value_group || ' | Label: ' || outcome || ' | Rows: ' || event_count AS summary FROM gold"""))
def table_function(spark, sf):
    path = shared_folder(spark, "gold")
    rollup(clean(intake_raw(spark, sf), CLEAN), COHORT).write.parquet(path)
    view = "gold_" + os.path.basename(path).replace("-", "_")
    spark.read.parquet(path).createOrReplaceTempView(view)
    name = register_cohort_summary(spark, view, "value_group", "outcome", "event_count", {})
    return spark.sql(f"SELECT s.* FROM (SELECT DISTINCT value_group FROM {view}) g, LATERAL {name}(g.value_group) s")


@query("udf_03_model_function", f"SELECT risk, COUNT(*) AS n_rows FROM (SELECT {RISK_SQL} AS risk FROM ({VITALS_SQL})) GROUP BY risk")
def model_function(spark, sf):
    rows = vitals(spark, sf).withColumn("prompt", risk_prompt(*[F.col(c) for c in ("age", "chol", "bp", "hr")]))
    return score_rows(rows, "prompt", rule_client(), output="risk").groupBy("risk").agg(F.count("*").alias("n_rows"))
