"""Confusion counts and the scores that follow from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lopside.functions.numbers import count_when, ratio, sum_when


def confusion_counts(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp of a 0/1 prediction."""
    y, p = F.col(label), F.col(pred)
    return df.groupBy(*by).agg(
        count_when((y == 0) & (p == 0)).alias("tn"), count_when((y == 0) & (p == 1)).alias("fp"),
        count_when((y == 1) & (p == 0)).alias("fn"), count_when((y == 1) & (p == 1)).alias("tp"))


def binary_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1, macro-F1 and the majority baseline."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    f1 = ratio(2 * tp, 2 * tp + fp + fn)
    other = ratio(2 * tn, 2 * tn + fp + fn)
    both = F.lit(2)
    return counts.select(
        *by, ratio(tn + tp, total).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), f1.alias("f1"), ((f1 + other) / both).alias("macro_f1"),
        ratio(F.greatest(tn + fp, fn + tp), total).alias("baseline_accuracy"),
        F.struct("tn", "fp", "fn", "tp").alias("confusion_matrix"), total.alias("n_test"))


def binary_report(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    return binary_scores(confusion_counts(df, label, pred, by), by)


def confusion_cells(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Count and within-class share of every (true, predicted) pair that occurs."""
    cells = df.groupBy(F.col(label).alias("true"), F.col(pred).alias("predicted")).agg(
        F.count("*").alias("n"))
    row = Window.partitionBy("true")
    return cells.withColumn("share", F.col("n") / F.sum("n").over(row))


def confusion_matrix(df: DataFrame, label: str, pred: str, labels: Sequence) -> DataFrame:
    """Wide counts, columns in the given label order."""
    return (df.groupBy(F.col(label).alias("true")).pivot(pred, list(labels))
            .agg(F.count(F.lit(1))).na.fill(0))


def top_confusions(cells: DataFrame, k: int = 15) -> DataFrame:
    return (cells.filter(F.col("true") != F.col("predicted"))
            .orderBy(F.desc("share"), "true", "predicted").limit(k))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support over all labels, true or predicted."""
    cells = df.groupBy(F.col(label).alias("t"), F.col(pred).alias("p")).agg(F.count("*").alias("n"))
    sides = F.explode(F.array(
        F.struct(F.col("t").alias("label"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp"))))
    sums = cells.select(sides.alias("s")).select("s.*").groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    return sums.select(
        "label", ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support", "predicted", "tp")


def report_totals(report: DataFrame) -> DataFrame:
    """Accuracy, macro and support-weighted averages of a class report, one row."""
    n = F.sum("support")

    def weighted(c: str):
        return ratio(F.sum(F.col(c) * F.col("support")), n)

    return report.agg(
        ratio(F.sum("tp"), n).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
        count_when(F.col("predicted") > 0).alias("classes_predicted"), n.alias("n_test"))


def full_report(report: DataFrame) -> DataFrame:
    """Class rows followed by the accuracy, macro and weighted rows, in one table."""
    classes = report.select("label", "precision", "recall", "f1", "support")
    averages = report_totals(report).select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.col("accuracy").alias("precision"),
                 F.col("accuracy").alias("recall"), F.col("accuracy").alias("f1"),
                 F.col("n_test").alias("support")),
        *[F.struct(F.lit(f"{kind} avg").alias("label"), F.col(f"{kind}_precision").alias("precision"),
                   F.col(f"{kind}_recall").alias("recall"), F.col(f"{kind}_f1").alias("f1"),
                   F.col("n_test").alias("support")) for kind in ("macro", "weighted")])).alias("r"))
    return classes.unionByName(averages.select("r.*"))


def money_summary(df: DataFrame, label: str, pred: str, amount: str, fee: float = 5.0) -> DataFrame:
    """Loss if nothing is done, cost of the decisions, net saving and the rates."""
    y, p, v = F.col(label), F.col(pred), F.col(amount)
    sums = df.agg(
        sum_when(y == 1, v).alias("do_nothing_loss"),
        sum_when((y == 1) & (p == 0), v).alias("missed_value"),
        count_when((y == 0) & (p == 1)).alias("false_alarms"),
        count_when((y == 1) & (p == 1)).alias("caught"),
        count_when((y == 1) & (p == 0)).alias("missed"),
        count_when(y == 0).alias("legitimate"))
    cost = F.col("missed_value") + F.col("false_alarms") * F.lit(float(fee))
    return sums.select(
        "do_nothing_loss", "missed_value", "false_alarms", "caught", "missed",
        cost.alias("total_cost"), (F.col("do_nothing_loss") - cost).alias("net_saving"),
        ratio(F.col("caught"), F.col("caught") + F.col("missed")).alias("catch_rate"),
        ratio(F.col("missed"), F.col("caught") + F.col("missed")).alias("miss_rate"),
        ratio(F.col("false_alarms"), F.col("legitimate")).alias("alarm_rate"),
        ratio(F.col("false_alarms"), F.col("caught")).alias("alarms_per_catch"))


def errors(df: DataFrame, label: str, pred: str, columns: Sequence[str]) -> DataFrame:
    """Missed positives and false alarms, named."""
    kind = F.when((F.col(label) == 1) & (F.col(pred) == 0), F.lit("missed")).when(
        (F.col(label) == 0) & (F.col(pred) == 1), F.lit("false alarm"))
    return df.withColumn("error", kind).filter(F.col("error").isNotNull()).select("error", *columns)
