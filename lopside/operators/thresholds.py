"""Threshold sweeps: one pass makes a histogram over the thresholds, the sums run on it."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lopside.functions.numbers import THRESHOLDS, ratio
from lopside.operators.sorted_passes import has_value


def sweep_counts(df: DataFrame, label: str, score: str, amount: Column | None = None,
                 thresholds: Sequence[float] = THRESHOLDS, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, positives, negatives and missed amount at every threshold.

    A row goes to the bucket "number of thresholds <= its score", found by binary
    search over the thresholds themselves, so a score equal to a threshold is
    predicted positive at it. Rows x thresholds are never produced. Rows without a
    score (null, NaN) or label are left out, as in the rankings.
    """
    by = list(by)
    levels = list(thresholds)
    y = F.col(label).cast("bigint")
    value = F.lit(0.0) if amount is None else amount.cast("double")
    rows = df.select(*by, y.alias("_y"), F.col(score).cast("double").alias("_p"), value.alias("_v"))
    placed = Bucketizer(splits=[-math.inf, *levels, math.inf], inputCol="_p", outputCol="_k").transform(
        rows.filter(has_value(F.col("_p")) & F.col("_y").isNotNull()))
    cells = placed.groupBy(*by, F.col("_k").cast("int").alias("k")).agg(
        F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"),
        F.sum(F.when(F.col("_y") == 1, F.col("_v")).otherwise(0.0)).alias("lost"))
    # Every threshold appears, also those between which no score falls.
    spark = df.sparkSession
    every = spark.range(len(levels) + 1).select(F.col("id").cast("int").alias("k"))
    if by:
        groups = cells.select(*by).distinct()
        every = groups.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(len(levels)))))
    empty = every.select(*by, "k", F.lit(0).cast("bigint").alias("pos"),
                         F.lit(0).cast("bigint").alias("neg"), F.lit(0.0).alias("lost"))
    full = cells.unionByName(empty).groupBy(*by, "k").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("lost").alias("lost"))
    group = Window.partitionBy(*(by or [F.lit(0)]))
    from_here = group.orderBy("k").rowsBetween(0, Window.unboundedFollowing)
    below = group.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    return (full.select(
        *by, "k", F.sum("pos").over(from_here).alias("tp"), F.sum("neg").over(from_here).alias("fp"),
        F.sum("pos").over(group).alias("positives"), F.sum("neg").over(group).alias("negatives"),
        F.coalesce(F.sum("lost").over(below), F.lit(0.0)).alias("fraud_loss"))
        .filter("k > 0")
        .withColumn("threshold", F.element_at(F.array(*[F.lit(t) for t in levels]), F.col("k"))))


def cost_curve(df: DataFrame, label: str, score: str, amount: Column, fee: float = 5.0,
               thresholds: Sequence[float] = THRESHOLDS, by: Sequence[str] = ()) -> DataFrame:
    """Money lost to missed positives plus a flat fee per false alarm."""
    counts = sweep_counts(df, label, score, amount, thresholds, by)
    alarm = F.col("fp") * F.lit(float(fee))
    return counts.select(
        *by, "threshold", "fraud_loss", alarm.alias("alarm_cost"),
        (F.col("fraud_loss") + alarm).alias("total_cost"),
        ratio(F.col("tp"), F.col("positives")).alias("recall"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def f1_curve(df: DataFrame, label: str, score: str, thresholds: Sequence[float] = THRESHOLDS,
             by: Sequence[str] = ()) -> DataFrame:
    counts = sweep_counts(df, label, score, None, thresholds, by)
    tp, fp, p = F.col("tp"), F.col("fp"), F.col("positives")
    return counts.select(
        *by, "threshold", ratio(tp, tp + fp).alias("precision"), ratio(tp, p).alias("recall"),
        ratio(2 * tp, tp + fp + p).alias("f1"))


def best_by(curve: DataFrame, metric: str, how: str = "max") -> DataFrame:
    """First row of the curve with the best metric."""
    order = F.desc(metric) if how == "max" else F.asc(metric)
    return curve.orderBy(order, "threshold").limit(1)


def nearest_to(curve: DataFrame, threshold: float = 0.5) -> DataFrame:
    return curve.orderBy(F.abs(F.col("threshold") - threshold), "threshold").limit(1)


def highest_reaching(curve: DataFrame, recall: Column | float) -> DataFrame:
    """The highest threshold whose recall still reaches the target."""
    target = recall if isinstance(recall, Column) else F.lit(float(recall))
    return curve.filter(F.col("recall") >= target).orderBy(F.desc("threshold")).limit(1)
