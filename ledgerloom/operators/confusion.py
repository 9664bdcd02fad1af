"""Confusion counts and the four metrics, each as one aggregate over the scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.casts import label_column
from ledgerloom.functions.dates import quote


def prediction_target(scored: DataFrame, prediction: str, target: str) -> DataFrame:
    """The two columns the metrics read."""
    return scored.select(F.col(quote(prediction)), F.col(quote(target)))


def count_columns(schema: T.StructType, prediction: str, target: str) -> list[Column]:
    """The aggregates ``tp, fp, tn, fn, n``, to be computed or observed.

    Labels and predictions other than 0 and 1 are in no cell, but ``n`` counts
    every row.
    """
    predicted = F.col(quote(prediction)).cast("double")
    actual = label_column(schema, target)
    return [
        F.count_if((actual == 1.0) & (predicted == 1.0)).alias("tp"),
        F.count_if((actual == 0.0) & (predicted == 1.0)).alias("fp"),
        F.count_if((actual == 0.0) & (predicted == 0.0)).alias("tn"),
        F.count_if((actual == 1.0) & (predicted == 0.0)).alias("fn"),
        F.count("*").alias("n"),
    ]


def confusion_counts(scored: DataFrame, prediction: str, target: str) -> DataFrame:
    """One row ``(tp, fp, tn, fn, n)``."""
    return scored.agg(*count_columns(scored.schema, prediction, target))


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """``(precision, recall, f1Score, accuracy)`` from confusion counts; NULL for 0/0."""
    tp, fp, tn, fn, n = (F.col(name) for name in ("tp", "fp", "tn", "fn", "n"))
    precision, recall = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    return counts.select(
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(2.0 * precision * recall, precision + recall).alias("f1Score"),
        F.try_divide(tp + tn, n).alias("accuracy"),
    )


def classification_metrics(scored: DataFrame, prediction: str, target: str) -> DataFrame:
    """The four metrics of a scored frame, in one pass and without moving its rows."""
    return metrics_from_counts(confusion_counts(scored, prediction, target))
