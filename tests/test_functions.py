"""Column expressions on hand-made rows: NULL, ties, edges, and a plain Python model of the answer check."""

import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoreline.functions.answers import answer_verdict
from shoreline.functions.labels import bucketize, code_label, flag_label, tier_points
from shoreline.functions.numbers import mean, percent, ratio
from shoreline.functions.risk import RiskLimits, register_risk_function, risk_level
from shoreline.functions.text import (assemble, assemble_or_blank, contains_any, count_hits, has_digit, normalize,
                                      numeric_tokens, row_sentence)


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_buckets_are_half_open_and_null_goes_last(spark):
    column = bucketize(F.col("x"), [40, 50, 60], ["Under 40", "40-49", "50-59", "60+"])
    got = values(spark, [(39,), (40,), (49,), (50,), (60,), (None,)], "x int", column)
    assert got == ["Under 40", "40-49", "40-49", "50-59", "60+", "60+"]


def test_buckets_reject_wrong_edges(spark):
    with pytest.raises(ValueError):
        bucketize(F.lit(1), [2, 1], ["a", "b", "c"])
    with pytest.raises(ValueError):
        bucketize(F.lit(1), [1], ["a"])


def test_code_and_flag_labels(spark):
    names = {0: "none", 1: "some"}
    rows = [(0,), (7,), (None,)]
    assert values(spark, rows, "x int", code_label(F.col("x"), names)) == ["none", None, None]
    assert values(spark, rows, "x int", code_label(F.col("x"), names, "?")) == ["none", "?", "?"]
    assert values(spark, rows, "x int", flag_label(F.col("x") == 0, "yes", "no")) == ["yes", "no", "no"]


def test_tiers(spark):
    tiers = [(0.7, 7), (0.9, 15)]
    assert values(spark, [(0.95,), (0.9,), (0.7,), (0.1,), (None,)], "x double", tier_points(F.col("x"), tiers)) == [15, 15, 7, 0, 0]
    assert values(spark, [(200,), (201,)], "x int", tier_points(F.col("x"), [(200, 5)], 1, strict=True)) == [1, 5]


def test_rates_never_divide_by_zero(spark):
    rows = [(1, 0), (1, 3), (None, 2)]
    assert values(spark, rows, "a int, b int", ratio(F.col("a"), F.col("b"))) == [None, 1 / 3, None]
    assert values(spark, rows, "a int, b int", percent(F.col("a"), F.col("b"))) == [None, 33.3, None]


def test_mean_does_not_depend_on_row_order(spark):
    rows = [(i * 0.01,) for i in range(1, 4001)]
    found = {spark.createDataFrame(r, "x double").repartition(n).agg(mean(F.col("x"), None, scale=2)).collect()[0][0]
             for r in (rows, rows[::-1]) for n in (1, 3, 7)}
    assert found == {20.005}
    assert spark.createDataFrame([(None,)], "x double").agg(mean(F.col("x"), 1, scale=2)).collect()[0][0] is None


def test_normalize_and_tokens(spark):
    rows = [("  About 1,234; or 5% \n",), (None,), ("-3e2 .5 nan 7x 1_0",)]
    assert values(spark, rows, "x string", normalize(F.col("x"))) == ["about 1234  or 5", "", "-3e2 .5 nan 7x 1_0"]
    tokens = values(spark, rows, "x string", numeric_tokens(normalize(F.col("x"))))
    assert tokens[0] == [1234.0, 5.0] and tokens[1] == []
    assert tokens[2][:2] == [-300.0, 0.5] and math.isnan(tokens[2][2]) and tokens[2][3] == 10.0


def test_word_tests(spark):
    rows = [("Average AGE",), ("average",), (None,)]
    assert values(spark, rows, "x string", contains_any(F.col("x"), ["age"])) == [True, True, None]
    assert values(spark, rows, "x string", contains_any(F.col("x"), ["age"], whole_words=True)) == [True, False, None]
    assert values(spark, rows, "x string", count_hits(F.col("x"), ["age", "aver", "zzz"])) == [2, 2, 0]
    assert values(spark, [("a1",), ("b",)], "x string", has_digit(F.col("x"))) == [True, False]


def test_assembly_with_nulls(spark):
    rows = [("a", 1), (None, 2)]
    assert values(spark, rows, "a string, b int", assemble("<", F.col("a"), ":", F.col("b"), ">")) == ["<a:1>", None]
    assert values(spark, rows, "a string, b int", assemble_or_blank("<", F.col("a"), ":", F.col("b"), ">")) == ["<a:1>", "<:2>"]
    assert values(spark, rows, "a string, b int", row_sentence(F.col("a"), F.col("b"))) == ["a, 1", "2"]


CASES = [
    ("375", "375", True), (" 375% ", "375", True), ("about 375.4 rows", "375", True), ("376", "375", False),
    ("", "375", False), (None, "375", False), ("ERROR: timeout", "375", False), ("failed 375", "375", False),
    ("no idea", "375", None), ("asymptomatic", "3 (asymptomatic)", True), ("60+ (95.4%)", "60+ (95.4%)", True),
    ("55.4", "Heart Disease: 55.4, Healthy: 44.4", True), ("anything", "", True), ("nan", "375", False), ("inf", "inf", True),
]


def test_answer_verdicts(spark):
    rows = [(a, k) for a, k, _ in CASES]
    assert values(spark, rows, "a string, k string", answer_verdict(F.col("a"), F.col("k"))) == [v for *_, v in CASES]


def test_strict_needs_every_expected_number(spark):
    rows = [("55.4", "sick: 55.4 well: 44.4"), ("44.4 and 55.4", "sick: 55.4 well: 44.4")]
    assert values(spark, rows, "a string, k string", answer_verdict(F.col("a"), F.col("k"), strict=True)) == [False, True]


WORD = st.sampled_from(["none", "unknown", "maybe"])
AMOUNT = st.integers(-500, 500)
MADE = st.one_of(
    AMOUNT.map(lambda n: (f"{n}", f"{n}", True)), AMOUNT.map(lambda n: (f" {n} % ", f"{n}", True)),
    AMOUNT.map(lambda n: (f"about {n} in all", f"{n}.4", True)), AMOUNT.map(lambda n: (f"{n}", f"{n + 1}", False)),
    AMOUNT.map(lambda n: (f"it is {n} or so", f"{n + 2}", False)), AMOUNT.map(lambda n: (f"error {n}", f"{n}", False)),
    st.tuples(WORD, AMOUNT).map(lambda p: (p[0], f"{p[1]}", None)), WORD.map(lambda w: (f"rather {w} then", w, True)),
    WORD.map(lambda w: (w.upper(), w, True)), WORD.map(lambda w: ("", w, False)))


@settings(max_examples=8, deadline=None)
@given(st.lists(MADE, min_size=20, max_size=60))
def test_verdicts_of_answers_made_to_be_right_wrong_or_open(spark, made):
    got = values(spark, [(a, k) for a, k, _ in made], "a string, k string", answer_verdict(F.col("a"), F.col("k")))
    assert got == [v for *_, v in made]


def test_risk_levels_and_sql_function(spark):
    rows = [(62.0, 280.0, 155.0, 140.0), (61.0, 200.0, 155.0, 90.0), (65.0, 180.0, 120.0, 90.0), (52.0, 230.0, 138.0, 90.0),
            (52.0, 230.0, 120.0, 90.0), (45.0, 201.0, 120.0, 101.0), (60.0, 300.0, 160.0, 50.0), (35.0, 280.0, 160.0, 150.0),
            (61.0, None, 151.0, None), (61.0, None, None, None)]
    expected = ["HIGH", "HIGH", "LOW", "MEDIUM", "LOW", "MEDIUM", "MEDIUM", "LOW", "HIGH", "LOW"]
    df = spark.createDataFrame(rows, "age double, chol double, bp double, hr double")
    assert [r[0] for r in df.select(risk_level(*[F.col(c) for c in df.columns])).collect()] == expected
    name = register_risk_function(spark, "risk_for_test", RiskLimits())
    assert [r[0] for r in df.select(F.expr(f"{name}(age, chol, bp, hr)")).collect()] == expected
