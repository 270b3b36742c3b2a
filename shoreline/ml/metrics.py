"""Metrics of a binary classifier from a table of labels and predictions."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.functions.numbers import count_where, ratio


def _cell(label: str, prediction: str, l: int, p: int) -> Column:
    return count_where((F.col(label) == l) & (F.col(prediction) == p))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    return df.agg(*[_cell(label, prediction, l, p).alias(n)
                    for n, l, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))])


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Confusion counts with accuracy, precision, recall and F1 of class 1 (0 where undefined)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def defined(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0))

    return confusion(df, label, prediction).select(
        "*", defined(ratio(tp + tn, tn + fp + fn + tp)).alias("accuracy"),
        defined(ratio(tp, tp + fp)).alias("precision"), defined(ratio(tp, tp + fn)).alias("recall"),
        defined(ratio(tp * 2, tp * 2 + fp + fn)).alias("f1_score"))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(class, precision, recall, f1_score, support) for both classes from one pass."""
    counts = confusion(df, label, prediction)

    def line(name: int, hit: str, wrong: str, missed: str) -> Column:
        h, w, m = F.col(hit), F.col(wrong), F.col(missed)
        return F.struct(
            F.lit(name).alias("class"), F.coalesce(ratio(h, h + w), F.lit(0.0)).alias("precision"),
            F.coalesce(ratio(h, h + m), F.lit(0.0)).alias("recall"),
            F.coalesce(ratio(h * 2, h * 2 + w + m), F.lit(0.0)).alias("f1_score"), (h + m).alias("support"))

    return counts.select(F.inline(F.array(line(0, "tn", "fn", "fp"), line(1, "tp", "fp", "fn"))))


def roc_auc(df: DataFrame, label: str, probability: str) -> float:
    """Exact area under the ROC curve; equal scores count half."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=probability, metricName="areaUnderROC", numBins=0)
    return evaluator.evaluate(df.select(F.col(label).cast("double").alias(label),
                                        F.col(probability).cast("double").alias(probability)))
