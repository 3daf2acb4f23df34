"""Confusion counts and metrics for 0/1 labels, for several prediction columns in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack_predictions(scored: DataFrame, label: str, predictions: dict[str, str]) -> DataFrame:
    """(model, actual, predicted): one row per input row and model, without a union (the
    table is scanned once)."""
    pairs = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.col(c).cast("bigint").alias("predicted"))
            for m, c in predictions.items()
        ]
    )
    return scored.select(F.col(label).cast("bigint").alias("actual"), F.inline(pairs))


def confusion_matrix(scored: DataFrame, label: str, predictions: dict[str, str]) -> DataFrame:
    """Contingency table per model: rows = actual label, columns = predicted 0 / 1 (the
    crosstab of the reference, computed distributed, map-side combined)."""
    s = stack_predictions(scored, label, predictions)
    return s.groupBy("model", "actual").agg(
        F.count_if(F.col("predicted") == 0).alias("predicted_0"),
        F.count_if(F.col("predicted") == 1).alias("predicted_1"),
    )


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is 0 (the metric library's zero-division value)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def classification_metrics(scored: DataFrame, label: str, predictions: dict[str, str]) -> DataFrame:
    """Accuracy, precision, recall and F1 of each model, from one aggregation."""
    s = stack_predictions(scored, label, predictions)
    a, p = F.col("actual"), F.col("predicted")
    counts = s.groupBy("model").agg(
        F.count_if((a == 1) & (p == 1)).alias("tp"),
        F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"),
        F.count_if((a == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ["tp", "fp", "fn", "tn"])
    return counts.select(
        "model", "tp", "fp", "fn", "tn",
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )
