"""Exact running totals, quantiles and ranks without a one-partition sort.

A window ordered by a value with no partition key puts every row in one task.
Here the rows are first cut into buckets of about equal row counts, in the order of
group and value, so a large group gets many buckets however narrow its values are.
A tiny table of bucket totals gives each bucket its starting offset, and the running
sum inside a bucket is an ordinary partitioned window. Equal values are collapsed
before the window, so one value held by a third of the rows is a single row.
Rows without a value (null or NaN) are left out by every pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lopside.operators.lookups import keep_matching, lookup_join
from lopside.session import buckets_for, durable

BUCKET = "_bucket"
SPREAD_ROWS = 50_000  # below this many rows a bucket is not worth a task
BUCKET_ROWS = 2_000_000  # and above this many it is too large for one


def cut_points(df: DataFrame, values: Sequence[str], buckets: int | None = None) -> list[list[float]]:
    """Approximate quantiles used only as bucket borders, one pass for all columns.

    They are read to the driver (a few thousand doubles at most) so that every
    later pass, and every retry of a lost task, uses the same borders.
    """
    n = buckets or buckets_for(df.sparkSession)
    probabilities = [i / n for i in range(1, n)]
    found = df.approxQuantile(list(values), probabilities, 1.0 / (2 * n))
    return [sorted({p for p in points if math.isfinite(p)}) for points in found]


def assign_bucket(df: DataFrame, value: str, points: Sequence[float], out: str = BUCKET) -> DataFrame:
    """Number of border points <= value, by binary search in the JVM."""
    if not points:
        return df.withColumn(out, F.lit(0))
    splits = [-math.inf, *points, math.inf]
    placed = Bucketizer(splits=splits, inputCol=value, outputCol=out).transform(df)
    return placed.withColumn(out, F.col(out).cast("int"))


def _over(by: Sequence[str]):
    # Only the bucket-total table is ever windowed with an empty ``by``.
    return Window.partitionBy(*(list(by) or [F.lit(0)]))


def has_value(c: Column) -> Column:
    """Neither null nor NaN. All rankings, sweeps and quantiles leave the other rows out."""
    return c.isNotNull() & ~F.isnan(c.cast("double"))


def range_buckets(df: DataFrame, order: Sequence[str], rows_per_bucket: int | None = None) -> DataFrame:
    """Number the rows' buckets in the order of ``order``; computed once and kept.

    Every bucket holds about the same number of rows; their number follows the row count.
    """
    df = durable(df)
    n = df.count()
    if rows_per_bucket is None:
        buckets = max(min(buckets_for(df.sparkSession), n // SPREAD_ROWS), n // BUCKET_ROWS)
    else:
        buckets = -(-n // rows_per_bucket)
    if buckets <= 1:
        return df.withColumn(BUCKET, F.lit(0))
    return durable(df.repartitionByRange(buckets, *order).withColumn(BUCKET, F.spark_partition_id()))


def running_totals(df: DataFrame, value: str, sums: Sequence[str], by: Sequence[str] = (),
                   descending: bool = False, rows_per_bucket: int | None = None) -> DataFrame:
    """Add ``cum_<s>`` (this row included) and ``all_<s>`` for each summed column.

    ``df`` holds one row for each (``by``, ``value``); rows without a value are left out.
    """
    by = list(by)
    placed = range_buckets(df.filter(has_value(F.col(value))), [*by, value], rows_per_bucket)

    def order(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    keys = [*by, BUCKET]
    earlier = _over(by).orderBy(order(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*keys).agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    offsets = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.coalesce(F.sum(f"_t_{s}").over(earlier), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(_over(by)).alias(f"all_{s}") for s in sums])
    inside = Window.partitionBy(*keys).orderBy(order(value)).rowsBetween(Window.unboundedPreceding, 0)
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by] + [F.col(BUCKET) == F.col(f"_k_{BUCKET}")]
    joined = placed.join(offsets, reduce(and_, same))
    return joined.select(
        *df.columns,
        *[(F.sum(s).over(inside) + F.col(f"_o_{s}")).alias(f"cum_{s}") for s in sums],
        *[F.col(f"all_{s}") for s in sums])


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per (row, column): its name, its double value and its bucket."""
    points = cut_points(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns)
    placed = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    for i, c in enumerate(columns):
        if points[i]:
            bucketizer = Bucketizer(splits=[-math.inf, *points[i], math.inf], inputCol=c,
                                    outputCol=f"_b{i}", handleInvalid="keep")
            placed = bucketizer.transform(placed)
        else:
            placed = placed.withColumn(f"_b{i}", F.lit(0.0))
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value"),
                 F.col(f"_b{i}").cast("int").alias(BUCKET))
        for i, c in enumerate(columns)]))
    return (placed.select(*by, cells.alias("_cell")).select(*by, "_cell.*")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Exact, linearly interpolated quantiles, long: (by..., column, p, value).

    Without groups two scans are enough: the first only counts buckets (combined before
    the shuffle), the second keeps just the buckets that hold a wanted rank, before its
    shuffle. With groups the distinct values get running counts, in buckets cut by group
    and value. No task sees a whole group, however large or narrow the group is.
    """
    by = list(by)
    if by:
        return _grouped_quantiles(df, columns, probabilities, by)
    keys = ["column"]
    long = _long(df, columns, by)
    counts = long.groupBy(*keys, BUCKET).agg(F.count("*").alias("_n"))
    earlier = _over(keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *keys, BUCKET, "_n",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(_over(keys)).alias("_total"))
    wanted = counts.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    at = F.col("p") * (F.col("_total") - 1)
    wanted = durable(
        wanted.withColumn("_at", at)
        .withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))))
        .filter((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n"))))
    # Equal values are merged before anything is joined on the bucket.
    merged = long.groupBy(*keys, BUCKET, "value").agg(F.count("*").alias("_m"))
    kept = keep_matching(merged, wanted.select(*keys, BUCKET).distinct(), [*keys, BUCKET])
    inside = Window.partitionBy(*keys, BUCKET).orderBy("value")
    kept = kept.withColumn("_to", F.sum("_m").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    hit = (wanted.join(kept, [*keys, BUCKET])
           .withColumn("_inside", F.col("_rank") - F.col("_before"))
           .filter((F.col("_to") - F.col("_m") <= F.col("_inside")) & (F.col("_inside") < F.col("_to"))))
    low = F.min("value")
    high = F.max("value")
    part = F.first("_at") - F.floor(F.first("_at"))
    return hit.groupBy(*keys, "p").agg((low + (high - low) * part).alias("value"))


def _grouped_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                       by: Sequence[str]) -> DataFrame:
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                for c in columns]))
    keys = [*by, "column"]
    merged = (df.select(*by, cells.alias("_cell")).select(*by, "_cell.*").filter(has_value(F.col("value")))
              .groupBy(*keys, "value").agg(F.count("*").alias("m")))
    run = running_totals(merged, "value", ["m"], keys)
    wanted = []
    for p in probabilities:
        at = F.lit(float(p)) * (F.col("all_m") - 1)
        wanted += [F.struct(F.lit(float(p)).alias("p"), at.alias("at"), rank.cast("bigint").alias("rank"))
                   for rank in (F.floor(at), F.ceil(at))]
    here = F.filter(F.array(*wanted), lambda w: (F.col("cum_m") - F.col("m") <= w["rank"]) & (w["rank"] < F.col("cum_m")))
    hit = run.select(*keys, "value", F.explode(here).alias("w"))
    part = F.first("w.at") - F.floor(F.first("w.at"))
    low, high = F.min("value"), F.max("value")
    return hit.groupBy(*keys, F.col("w.p").alias("p")).agg((low + (high - low) * part).alias("value"))


def average_ranks(df: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """One row per distinct value with its tie-averaged rank (1-based); null and NaN have none."""
    n = F.sum(weight) if weight else F.count("*")
    distinct = df.groupBy(value).agg(n.cast("bigint").alias("n"))
    ranked = running_totals(distinct, value, ["n"])
    return ranked.select(
        value, "n", (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2).alias("avg_rank"))


def spearman(df: DataFrame, a: str, b: str, out: str = "spearman") -> DataFrame:
    """Rank correlation with averaged ties, as a one-row table.

    Equal pairs are merged first. The rank tables are joined with salt, because a
    value such as 0 may belong to most of the pairs.
    """
    clean = df.select(F.col(a).cast("double").alias("_a"), F.col(b).cast("double").alias("_b")).dropna()
    pairs = clean.groupBy("_a", "_b").agg(F.count("*").alias("_w"))
    for side in ("_a", "_b"):
        ranks = average_ranks(pairs, side, "_w").select(side, F.col("avg_rank").alias(f"{side}_rank"))
        pairs = lookup_join(pairs, ranks, [side])
    x, y, w = F.col("_a_rank"), F.col("_b_rank"), F.col("_w")
    sums = pairs.agg(F.sum(w).alias("n"), F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"),
                     F.sum(w * x * x).alias("sxx"), F.sum(w * y * y).alias("syy"),
                     F.sum(w * x * y).alias("sxy"))
    n = F.col("n")
    spread = F.sqrt((n * F.col("sxx") - F.col("sx") * F.col("sx"))
                    * (n * F.col("syy") - F.col("sy") * F.col("sy")))
    return sums.select(
        n.cast("bigint").alias("n"),
        F.try_divide(n * F.col("sxy") - F.col("sx") * F.col("sy"), spread).alias(out))


def hash_key(row_key: Column, seed: int | str = 42) -> Column:
    """Order that looks random but is the same on any cluster layout."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_key.cast("string")))


def numbered(df: DataFrame, order: Column, out: str = "n", digits: int = 4) -> DataFrame:
    """Number all rows 1..N in the order of a hash key.

    The first hex digits of the hash are the buckets: they are even by nature, so
    no sampling is needed.
    """
    keyed = df.withColumn("_key", order).withColumn(BUCKET, F.substring("_key", 1, digits))
    totals = keyed.groupBy(BUCKET).agg(F.count("*").alias("_t"))
    earlier = _over([]).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(BUCKET, F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_o"))
    inside = Window.partitionBy(BUCKET).orderBy("_key")
    return (keyed.join(offsets, BUCKET)
            .withColumn(out, F.row_number().over(inside) + F.col("_o"))
            .drop("_key", BUCKET, "_o"))
