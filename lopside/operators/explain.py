"""What a fitted model depends on: permutation importance and what-if probes."""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lopside.functions.transactions import hour_sweep
from lopside.operators.ranking import rank_metrics, ranking_points
from lopside.operators.sorted_passes import hash_key, numbered
from lopside.session import durable


def shuffled_copies(df: DataFrame, row_id: str, features: Sequence[str], repeats: int,
                    seed: int = 42) -> DataFrame:
    """Copies of the rows, keyed (column, repeat), each with that column dealt out again.

    The rows are numbered once in a random order. In a copy every row takes the
    value of the row a random distance further on in that order, so one join serves
    all copies, and the plan does not grow with their number. The copy keyed
    ('', 0) is unchanged.
    """
    base = durable(numbered(df, hash_key(F.col(row_id), f"{seed}:order"), "_k"))
    n = base.count()
    draw = random.Random(seed)
    copies = [("", 0, 0)] + [(c, r, draw.randrange(1, n) if n > 1 else 0)
                             for c in features for r in range(repeats)]
    keys = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(r).alias("repeat"), F.lit(o).cast("bigint").alias("off"))
        for c, r, o in copies]))
    takers = base.withColumn("_copy", keys).withColumn(
        "_from", F.pmod(F.col("_k") - 1 + F.col("_copy.off"), F.lit(n)) + 1)
    givers = base.select(F.col("_k").alias("_from"), F.struct(*features).alias("_given"))
    joined = takers.join(givers, "_from")
    return joined.select(
        "_copy.column", "_copy.repeat", *[c for c in df.columns if c not in features],
        *[F.when(F.col("_copy.column") == c, F.col(f"_given.{c}")).otherwise(F.col(c)).alias(c)
          for c in features])


def permutation_importance(score: Callable[[DataFrame], DataFrame], df: DataFrame, row_id: str,
                           label: str, features: Sequence[str], metric: str = "average_precision",
                           repeats: int = 5, seed: int = 42) -> DataFrame:
    """Mean drop of a ranking metric when a column is shuffled.

    All shuffled copies are scored as one table; ``score`` adds the probability ``p``.
    """
    keys = ["column", "repeat"]
    stacked = shuffled_copies(df.select(row_id, label, *features), row_id, features, repeats, seed)
    scored = durable(score(stacked).select(*keys, label, "p"))
    found = durable(rank_metrics(ranking_points(scored, label, "p", keys), keys))
    reference = found.filter("column = ''").select(metric).scalar()
    drops = found.filter("column <> ''").withColumn("drop", reference - F.col(metric))
    return drops.groupBy("column").agg(
        F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("std"),
        F.count("*").alias("repeats")).orderBy(F.desc("importance"), "column")


# Fixed windows of the day: name, first hour, last hour.
HOUR_WINDOWS = [("00:00-03:59", 0, 3), ("04:00-11:59", 4, 11), ("12:00-21:59", 12, 21),
                ("22:00-23:59", 22, 23)]


def hour_windows(rates: DataFrame, hour: str, value: str, out: str) -> DataFrame:
    """Mean over the hours of each window; hours without a value are skipped."""
    name = F.lit(None).cast("string")
    for label, first, last in HOUR_WINDOWS:
        name = F.when(F.col(hour).between(first, last), F.lit(label)).otherwise(name)
    fixed = F.explode(F.array(*[F.lit(w[0]) for w in HOUR_WINDOWS]))
    keys = rates.sparkSession.range(1).select(fixed.alias("window"))
    means = rates.groupBy(name.alias("window")).agg(F.avg(value).alias(out))
    return keys.join(means, "window", "left")


def faithfulness(probe: DataFrame, band: DataFrame, score: Callable[[DataFrame], DataFrame],
                 label: str) -> DataFrame:
    """Model mean by window of the day against the observed rate, and both rankings.

    The probe rows are scored at all 24 hours in one pass.
    """
    model = (score(hour_sweep(probe)).groupBy("hour").agg(F.avg("p").alias("p")))
    data = band.groupBy("hour").agg(F.avg(F.col(label).cast("double")).alias("rate"))
    both = hour_windows(model, "hour", "p", "model_says").join(
        hour_windows(data, "hour", "rate", "data_says"), "window")
    # Four rows from here on.
    one = Window.partitionBy(F.lit(0))
    return (both.withColumn("gap", F.col("model_says") - F.col("data_says"))
            .withColumn("model_rank", F.row_number().over(one.orderBy(F.desc("model_says"), "window")))
            .withColumn("data_rank", F.row_number().over(
                one.orderBy(F.desc_nulls_last("data_says"), "window")))
            .withColumn("same_rank", F.col("model_rank") == F.col("data_rank"))
            .withColumn("same_order", F.bool_and("same_rank").over(one)))
