"""Scores for several labels per row, for coarser labels, and for probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lopside.functions.numbers import count_when, ratio
from lopside.operators.lookups import attach


def label_scores(df: DataFrame, true: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 of each label over array columns."""
    both = F.array_union(true, predicted)
    rows = df.select(true, predicted, F.explode(both).alias("label")).select(
        "label", F.array_contains(true, F.col("label")).alias("t"),
        F.array_contains(predicted, F.col("label")).alias("p"))
    sums = rows.groupBy("label").agg(
        count_when(F.col("t") & F.col("p")).alias("tp"), count_when(F.col("t")).alias("support"),
        count_when(F.col("p")).alias("predicted"))
    return sums.select(
        "label", ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"), "support")


def subset_accuracy(df: DataFrame, true: str, predicted: str) -> DataFrame:
    same = F.sort_array(F.array_distinct(true)) == F.sort_array(F.array_distinct(predicted))
    return df.agg(F.avg(same.cast("double")).alias("subset_accuracy"), F.count("*").alias("n"))


def coarser(df: DataFrame, label: str, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """Replace a label by its group from a mapping table; unmapped labels stay."""
    lookup = mapping.select(F.col(source).alias(label), F.col(target).alias("_group"))
    out = attach(df, lookup, [label], "left")
    return out.withColumn(label, F.coalesce("_group", label)).select(*df.columns)


def reliability(df: DataFrame, label: str, p: Column, bins: int = 10) -> DataFrame:
    """Mean probability against observed rate in equal bins of the score."""
    cell = F.least(F.floor(p * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(cell.alias("bin")).agg(
        F.count("*").alias("n"), F.avg(p).alias("mean_p"),
        F.avg(F.col(label).cast("double")).alias("rate"))
