"""Velocity features of a card, from its past only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lopside.functions.transactions import epoch_micros

HOUR = 3_600_000_000
DAY = 24 * HOUR


def velocity(df: DataFrame, row_id: str, card: str, at: str, amount: str) -> DataFrame:
    """Count in the last hour and day, amount against the card's past mean, time since last.

    A card is cut into days, so that one very busy card is spread over many tasks.
    A day also receives the rows of the day before (for the 24-hour window), and
    everything earlier arrives as one line of running totals per card and day.
    Rows at the same microsecond do not see each other.
    """
    rows = df.select(F.col(row_id).alias("_id"), F.col(card).alias("_c"),
                     epoch_micros(F.col(at)).alias("us"), F.col(amount).cast("double").alias("v"))
    rows = rows.withColumn("_day", F.floor(F.col("us") / DAY))
    days = rows.groupBy("_c", "_day").agg(
        F.count("*").alias("n"), F.sum("v").alias("s"), F.max("us").alias("last"))
    before = Window.partitionBy("_c").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select(
        "_c", "_day", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("s").over(before), F.lit(0.0)).alias("s0"), F.max("last").over(before).alias("last0"))
    copies = rows.withColumn("_slot", F.explode(F.array("_day", F.col("_day") + 1)))
    slot = Window.partitionBy("_c", "_slot").orderBy("us")
    own = F.when(F.col("_day") == F.col("_slot"), F.lit(1))
    placed = copies.withColumns({
        "last_1h": F.count("*").over(slot.rangeBetween(-HOUR, -1)),
        "last_24h": F.count("*").over(slot.rangeBetween(-DAY, -1)),
        "n1": F.count(own).over(slot.rangeBetween(Window.unboundedPreceding, -1)),
        "s1": F.sum(F.when(F.col("_day") == F.col("_slot"), F.col("v"))).over(
            slot.rangeBetween(Window.unboundedPreceding, -1)),
        "p1": F.max(F.when(F.col("_day") == F.col("_slot"), F.col("us"))).over(
            slot.rangeBetween(Window.unboundedPreceding, -1))}).filter("_day = _slot")
    joined = placed.join(carried, ["_c", "_day"])
    n = F.col("n0") + F.col("n1")
    mean = F.try_divide(F.col("s0") + F.coalesce("s1", F.lit(0.0)), n)
    previous = F.coalesce("p1", "last0")
    return joined.select(
        F.col("_id").alias(row_id), F.col("_c").alias(card), "last_1h", "last_24h",
        n.alias("n_past"), mean.alias("past_mean"),
        F.try_divide(F.col("v"), mean).alias("amount_vs_mean"),
        ((F.col("us") - previous) / 1e6).alias("seconds_since_last"))
