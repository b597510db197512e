"""Exact ranking metrics: ROC and precision-recall points, AUC, average precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lopside.functions.numbers import ratio
from lopside.operators.sorted_passes import has_value, running_totals


def ranking_points(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score: counts at it and, from the top, tp and fp.

    Rows without a score (null, NaN) or label are left out, as in the threshold sweeps.
    """
    by = list(by)
    y = F.col(label).cast("bigint")
    narrow = df.select(*by, y.alias("_y"), F.col(score).cast("double").alias("score"))
    narrow = narrow.filter(has_value(F.col("score")) & F.col("_y").isNotNull())
    tied = narrow.groupBy(*by, "score").agg(
        F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"))
    out = running_totals(tied, "score", ["pos", "neg"], by, descending=True)
    return out.select(*by, "score", "pos", "neg", F.col("cum_pos").alias("tp"),
                      F.col("cum_neg").alias("fp"), F.col("all_pos").alias("positives"),
                      F.col("all_neg").alias("negatives"))


def rank_metrics(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties count half) and step-wise average precision."""
    tp, fp, pos = F.col("tp"), F.col("fp"), F.col("pos")
    share_pos = ratio(pos, F.col("positives"))
    share_neg = ratio(F.col("neg"), F.col("negatives"))
    return points.groupBy(*by).agg(
        F.sum(share_neg * ratio(tp - pos / 2, F.col("positives"))).alias("roc_auc"),
        F.sum(share_pos * ratio(tp, tp + fp)).alias("average_precision"))


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return rank_metrics(ranking_points(df, label, score, by), by).select(*by, "roc_auc")


def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return (rank_metrics(ranking_points(df, label, score, by), by)
            .select(*by, "average_precision"))


def roc_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(fpr, tpr, threshold) for each distinct score, and the (0, 0, inf) start."""
    points = ranking_points(df, label, score, by)
    curve = points.select(
        *by, ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
        ratio(F.col("tp"), F.col("positives")).alias("tpr"), F.col("score").alias("threshold"))
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1)
    start = groups.select(*by, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
                          F.lit(float("inf")).alias("threshold"))
    return curve.unionByName(start)


def pr_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
             end_point: bool = True) -> DataFrame:
    """(precision, recall, threshold) for each distinct score, and the (1, 0) end."""
    points = ranking_points(df, label, score, by)
    curve = points.select(
        *by, ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("positives")).alias("recall"), F.col("score").alias("threshold"))
    if not end_point:
        return curve
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1)
    end = groups.select(*by, F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
                        F.lit(None).cast("double").alias("threshold"))
    return curve.unionByName(end)


def best_precision_at_recall(curve: DataFrame, targets: Sequence[float]) -> DataFrame:
    """Highest precision among points reaching each recall; lowest threshold on a tie."""
    reach = F.filter(F.array(*[F.lit(float(t)) for t in targets]), lambda t: t <= F.col("recall"))
    best = F.max(F.struct("precision", (-F.col("threshold")).alias("low"), "recall"))
    return (curve.filter(F.col("threshold").isNotNull())
            .withColumn("target_recall", F.explode(reach))
            .groupBy("target_recall").agg(best.alias("b"))
            .select("target_recall", (-F.col("b.low")).alias("threshold"),
                    F.col("b.precision").alias("precision"), F.col("b.recall").alias("recall")))


def order_disagreement(results: DataFrame, model: str, a: str, b: str) -> DataFrame:
    """Rank of each model by two metrics, and whether they agree.

    For a results table: one row per fitted model.
    """
    def place(metric: str):
        return F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(metric), model))
    return (results.withColumn("rank_a", place(a)).withColumn("rank_b", place(b))
            .withColumn("same_rank", F.col("rank_a") == F.col("rank_b")))
