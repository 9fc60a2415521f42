"""Exact ROC and precision-recall curves, and the areas under them.

Equal scores are counted together first, so a score that many rows share is one row. The distinct scores are
cut into ranges and written; the sums of the ranges, one row each, give where each one begins, and the running
counts are taken inside the ranges. No task sees more than one range, nothing but the areas reaches the driver.

Rows with a null score or label take no part. NaN counts as the highest score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsight.session import written


def running_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """`score, positives, negatives` of each distinct score, and how many lie above it (`*_before`)."""
    spark = scored.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    actual = F.col(label) == 1
    counts = (
        scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(actual).alias("positives"), F.count_if(~actual).alias("negatives"))
    )
    ranged = counts.repartitionByRange(parts, F.desc("score")).withColumn("_range", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    sides = ("positives", "negatives")
    starts = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_{c}") for c in sides])
    starts = starts.select("_range", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in sides])
    sums = {f"{c}_before": F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_{c}") for c in sides}
    return ranged.join(F.broadcast(starts), "_range").withColumns(sums).select("score", *sides, *sums)


def curve(scored: DataFrame, score: str = "logistic", label: str = "isFraud") -> DataFrame:
    """One row for each distinct score as threshold (calls are rows at or above it).

    `score, true_positives, false_positives, recall, false_positive_rate, precision`; a rate whose
    class is empty is null.
    """
    counts = written(running_counts(scored, score, label), "counts")
    totals = counts.agg(F.sum("positives").alias("_p"), F.sum("negatives").alias("_n"))
    tp, fp = F.col("positives_before") + F.col("positives"), F.col("negatives_before") + F.col("negatives")
    rows = counts.withColumns({"true_positives": tp, "false_positives": fp}).crossJoin(F.broadcast(totals))  # one row
    return rows.select(
        "score",
        "true_positives",
        "false_positives",
        F.try_divide("true_positives", "_p").alias("recall"),
        F.try_divide("false_positives", "_n").alias("false_positive_rate"),
        F.try_divide("true_positives", F.col("true_positives") + F.col("false_positives")).alias("precision"),
    )


def areas(scored: DataFrame, score: str = "logistic", label: str = "isFraud") -> DataFrame:
    """`positives, negatives, roc_area, average_precision` as one row.

    The area under the ROC curve (trapezoids) is summed in whole numbers; average precision is the sum of
    precision over the steps of recall. Both are null where a class is empty.
    """
    whole = {c: F.col(c).cast("decimal(18,0)") for c in ("positives", "negatives", "positives_before")}
    twice = whole["negatives"] * (whole["positives_before"] * 2 + whole["positives"])
    tp = F.col("positives_before") + F.col("positives")
    called = tp + F.col("negatives_before") + F.col("negatives")
    sums = running_counts(scored, score, label).agg(
        F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("negatives"), F.lit(0)).alias("negatives"),
        F.sum(twice).cast("double").alias("_twice"),
        F.sum(F.col("positives") * tp / called).alias("_steps"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives") * 2
    return sums.select(
        "positives",
        "negatives",
        F.try_divide("_twice", pairs).alias("roc_area"),
        F.when(pairs > 0, F.try_divide("_steps", "positives")).alias("average_precision"),
    )
