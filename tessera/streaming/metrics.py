"""Metrics of a stream of predictions, by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_confusion(predictions: DataFrame, time: str, label: str, predicted: str, by: list[str], width: str, late: str) -> DataFrame:
    """Confusion counts of each window of event time and slice; rows later than ``late`` are left out.

    Runs on a stream (append or update mode) and, with the same rows, on a table.
    """
    y, p = F.col(label), F.col(predicted)
    counts = {"tp": (y == 1) & (p == 1), "fp": (y == 0) & (p == 1), "tn": (y == 0) & (p == 0), "fn": (y == 1) & (p == 0)}
    rows = predictions.withWatermark(time, late) if predictions.isStreaming else predictions
    out = rows.groupBy(F.window(time, width).alias("w"), *by).agg(*(F.count_if(c).alias(k) for k, c in counts.items()))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, *counts)
