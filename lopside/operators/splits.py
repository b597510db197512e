"""Exact splits and samples that are the same on any cluster layout.

Rows are ordered inside a class by a hash of the row id. To take the first m rows
of a class only the hash of its m-th row is needed, and that cut is found from
counts of hash prefixes plus one narrow slice, so the table itself is never
shuffled or sorted, however large one class is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lopside.operators.lookups import attach
from lopside.operators.sorted_passes import hash_key
from lopside.session import durable

PREFIX = 4


def _cuts(df: DataFrame, label: Column, row_id: str, targets, seed) -> DataFrame:
    """Per class, the hash of the row at each target rank ('' for rank 0)."""
    keyed = df.select(label.alias("_c"), hash_key(F.col(row_id), seed).alias("_h"))
    keyed = keyed.withColumn("_b", F.substring("_h", 1, PREFIX))
    cells = keyed.groupBy("_c", "_b").agg(F.count("*").alias("m"))
    group = Window.partitionBy("_c")
    # At most 65,536 lines per class, used three times below.
    cells = durable(cells.select(
        "_c", "_b", "m", F.sum("m").over(group).alias("n_c"),
        F.sum("m").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)).alias("upto")))
    wanted = cells.select("*", F.posexplode(targets(F.col("n_c"))).alias("j", "target"))
    here = wanted.filter((F.col("upto") - F.col("m") < F.col("target")) & (F.col("target") <= F.col("upto")))
    slices = attach(keyed, here.select(
        "_c", "_b", "j", (F.col("target") - F.col("upto") + F.col("m")).alias("nth")).groupBy("_c", "_b")
        .agg(F.collect_list(F.struct("j", "nth")).alias("asks")), ["_c", "_b"])
    rank = F.row_number().over(Window.partitionBy("_c", "_b").orderBy("_h"))
    hits = slices.withColumn("r", rank).select("_c", "_h", F.filter(
        "asks", lambda a: a["nth"] == F.col("r")).alias("asks"))
    found = hits.filter(F.size("asks") > 0).select("_c", "_h", F.explode("asks").alias("a"))
    asked = cells.groupBy("_c").agg(F.max("n_c").alias("n_c"))
    cuts = found.groupBy("_c").agg(F.collect_list(F.struct(F.col("a.j").alias("j"), "_h")).alias("hits"))
    out = asked.join(cuts, "_c", "left")
    # A target of 0 has no row; its cut sorts before every hash.
    return out.select("_c", F.transform(targets(F.col("n_c")), lambda t, j: F.coalesce(
        F.try_element_at(F.transform(F.filter("hits", lambda h: h["j"] == j), lambda h: h["_h"]),
                         F.lit(1)), F.lit(""))).alias("cuts"))


def with_test_flag(df: DataFrame, label: str, row_id: str, fraction: float = 0.2,
                   seed: int = 42) -> DataFrame:
    """Add ``in_test``: exactly ``round(fraction * n)`` rows of each class."""
    def targets(n: Column) -> Column:
        return F.array(F.round(n * F.lit(fraction)).cast("bigint"))
    cuts = _cuts(df, F.col(label), row_id, targets, seed).withColumnRenamed("_c", label)
    flagged = attach(df, cuts, [label])
    return flagged.withColumn(
        "in_test", (hash_key(F.col(row_id), seed) <= F.col("cuts")[0])).drop("cuts").select(
        *df.columns, "in_test")


def stratified_split(df: DataFrame, label: str, row_id: str, fraction: float = 0.2,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the class shares kept exactly."""
    flagged = with_test_flag(df, label, row_id, fraction, seed)
    return (flagged.filter(~F.col("in_test")).drop("in_test"),
            flagged.filter("in_test").drop("in_test"))


def with_fold(df: DataFrame, label: str, row_id: str, k: int, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1; inside a class the fold sizes differ by at most one."""
    def targets(n: Column) -> Column:
        return F.array(*[F.floor(n * i / k).cast("bigint") for i in range(1, k)])
    cuts = _cuts(df, F.col(label), row_id, targets, seed).withColumnRenamed("_c", label)
    key = hash_key(F.col(row_id), seed)
    fold = F.size(F.filter("cuts", lambda c: c < key))
    return attach(df, cuts, [label]).withColumn("fold", fold).select(*df.columns, "fold")


def fixed_sample(df: DataFrame, row_id: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), chosen by hash order."""
    def targets(total: Column) -> Column:
        return F.array(F.least(total, F.lit(n)).cast("bigint"))
    cut = _cuts(df, F.lit(0), row_id, targets, seed).select(F.col("cuts")[0].alias("c"))
    return df.filter(hash_key(F.col(row_id), seed) <= cut.scalar())


def temporal_split(df: DataFrame, at: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """Rows strictly before the cut, and rows from it on."""
    moment = F.lit(cut).cast(df.schema[at].dataType)
    return df.filter(F.col(at) < moment), df.filter(F.col(at) >= moment)


def check_time_order(train: DataFrame, test: DataFrame, at: str) -> DataFrame:
    """Bounds of both periods and whether training ends before testing starts."""
    both = train.select(at, F.lit("train").alias("part")).unionByName(
        test.select(at, F.lit("test").alias("part")))
    out = both.agg(
        F.max(F.when(F.col("part") == "train", F.col(at))).alias("train_end"),
        F.min(F.when(F.col("part") == "test", F.col(at))).alias("test_start"))
    return out.withColumn("in_order", F.col("train_end") < F.col("test_start"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) of each class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    return counts.withColumn("weight", whole.select("n").scalar()
                             / (whole.select("k").scalar() * F.col("n")))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    return attach(df, class_weights(df, label).select(label, F.col("weight").alias(out)), [label])


def feature_set(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Columns in training order."""
    return df.select(*keep, *features)
