"""Profiling a table: sizes, nulls, duplicates, class balance, rates, descriptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from lopside.functions.numbers import count_when, ratio
from lopside.operators.lookups import attach, small_rows
from lopside.operators.sorted_passes import exact_quantiles


# ---- columns, from the schema alone -------------------------------------------------

def columns_except(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(excluded)]


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def key_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Keys to group by, named ``_key0``.. : of a text its 256-bit digest, so that long texts are not shuffled as keys."""
    texts = {f.name for f in df.schema.fields if f.dataType == StringType()}
    return [(F.sha2(F.col(c), 256) if c in texts else F.col(c)).alias(f"_key{i}") for i, c in enumerate(keys)]


# ---- sizes and quality ----------------------------------------------------------------

def table_size(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct values per column, long.

    The (column, value) pairs are merged before the shuffle, so a frequent value
    costs one row per task.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    unique = df.select(pairs.alias("p")).select("p.*").filter(F.col("value").isNotNull()).distinct()
    return unique.groupBy("column").agg(F.count("*").alias("n_distinct"))


def distinct_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of groups; rows with a missing key form none."""
    return (df.select(*columns).na.drop().distinct().agg(F.count("*").alias("n_groups")))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column and in all, one pass."""
    per_column = [count_when(F.col(c).isNull()).alias(c) for c in df.columns]
    wide = df.agg(*per_column)
    total = sum((F.col(c) for c in df.columns), F.lit(0).cast("bigint"))
    return wide.withColumn("total_missing", total)


def duplicate_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each set of equal rows; nulls are equal."""
    # The whole row is long: its digest is what is shuffled. Nulls differ from empty texts.
    parts = [F.coalesce(F.concat(F.lit("1"), F.col(c).cast("string")), F.lit("0")) for c in columns]
    groups = df.select(F.sha2(F.to_json(F.array(*parts)), 256).alias("_row")).groupBy("_row").agg(F.count("*").alias("n"))
    return groups.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_distinct"),
                      (F.sum("n") - F.count("*")).alias("n_duplicates"))


def duplicates_by_class(df: DataFrame, key: str, label: str, order: str) -> DataFrame:
    """Class counts of the second and later copies of a key.

    Copies are counted, never listed: per (key, class) first, then the class of
    each key's first row is taken away.
    """
    sizes = df.groupBy(*key_columns(df, [key]), label).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    firsts = (sizes.groupBy("_key0").agg(F.min(F.struct("_first", label)).alias("f"))
              .select(F.col(f"f.{label}").alias(label), F.lit(-1).cast("bigint").alias("n")))
    return (sizes.select(label, "n").unionByName(firsts).groupBy(label)
            .agg(F.sum("n").alias("n_duplicates")).filter("n_duplicates > 0"))


def conflicting_labels(df: DataFrame, key: str, label: str) -> DataFrame:
    """Keys that carry more than one label, and of how many.

    Texts are counted by their digests; only those in conflict are shuffled themselves.
    """
    keyed = df.select(key, label, *key_columns(df, [key])).na.drop()
    counts = (keyed.select("_key0", label).distinct().groupBy("_key0").agg(F.count("*").alias("n_labels"))
              .filter("n_labels > 1"))
    return attach(keyed.select(key, "_key0"), counts, ["_key0"]).groupBy(key).agg(F.max("n_labels").alias("n_labels"))


def dedup_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keep the first row of each key by ``order``.

    A minimum over rows combines before the shuffle: a key that owns a third of
    the table sends one row per task. Text keys are grouped by their digests. Rows
    without ``order`` come last.
    """
    place = F.struct(F.col(order).isNull().alias("late"), F.col(order).alias("at"))
    out = df.groupBy(*key_columns(df, keys)).agg(F.min_by(F.struct(*df.columns), place).alias("_row"))
    return out.select("_row.*")


# ---- class balance ---------------------------------------------------------------------

def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), column)


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """Largest and smallest class, their ratio, top-2 share, majority baseline."""
    counts = df.groupBy(F.col(label).alias("c")).agg(F.count("*").alias("n"))
    top2 = counts.orderBy(F.desc("n"), "c").limit(2).agg(F.sum("n").alias("n")).scalar()
    place = F.struct((-F.col("n")).alias("m"), "c")
    ends = counts.agg(F.count("*").alias("n_classes"), F.sum("n").alias("n_rows"),
                      F.min(place).alias("first"), F.max(place).alias("last"))
    return ends.select(
        "n_classes", F.col("first.c").alias("largest"), (-F.col("first.m")).alias("n_largest"),
        F.col("last.c").alias("smallest"), (-F.col("last.m")).alias("n_smallest"),
        (F.col("first.m") / F.col("last.m")).alias("ratio"), (top2 / F.col("n_rows")).alias("top2_share"),
        (-F.col("first.m") / F.col("n_rows")).alias("baseline_accuracy"))


def load_summary(df: DataFrame, label: str, at: str | None = None) -> DataFrame:
    """Rows, date range, positive rate and the all-negative baseline."""
    rate = F.avg(F.col(label).cast("double"))
    dates = [F.to_date(F.min(at)).cast("string").alias("first_day"),
             F.to_date(F.max(at)).cast("string").alias("last_day")] if at else []
    return df.agg(F.count("*").alias("n_rows"), *dates, rate.alias("positive_rate"),
                  (1 - rate).alias("baseline_accuracy"))


def dataset_defaults(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Median of numeric and most frequent value of categorical columns, long.

    The smallest value wins a tie between categories.
    """
    medians = (exact_quantiles(df, numeric, [0.5])
               .select("column", F.col("value").alias("median"), F.lit(None).cast("string").alias("mode")))
    if not categorical:
        return medians
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in categorical]))
    counts = (df.select(pairs.alias("p")).select("p.*").filter("value is not null")
              .groupBy("column", "value").agg(F.count("*").alias("n")))
    modes = counts.groupBy("column").agg(
        F.min(F.struct((-F.col("n")).alias("m"), "value")).alias("s")).select(
        "column", F.lit(None).cast("double").alias("median"), F.col("s.value").alias("mode"))
    return medians.unionByName(modes)


def fill_defaults(df: DataFrame, defaults: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace missing inputs by the dataset defaults.

    The defaults have one row per column and become literals of a projection. A column
    without any value has no default and stays empty.
    """
    schema = {f.name: f.dataType for f in df.schema.fields}
    found = {r["column"]: r for r in small_rows(defaults)}

    def default(c: str) -> Column:
        if c not in found:  # no row has a value
            return F.lit(None).cast(schema[c])
        return F.lit(found[c]["median" if isinstance(schema[c], NumericType) else "mode"]).cast(schema[c])

    return df.withColumns({c: F.coalesce(F.col(c), default(c)) for c in columns})


# ---- rates ---------------------------------------------------------------------------

def rate_by(df: DataFrame, by: Sequence[str] | str, label: str, thin: int | None = None) -> DataFrame:
    """Rows and positive rate per group; groups below ``thin`` rows are flagged."""
    keys = [by] if isinstance(by, str) else list(by)
    out = df.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(F.col(label).cast("double")).alias("rate"))
    if thin is not None:
        out = out.withColumn("base", F.when(F.col("n") < thin, "thin base").otherwise("ok"))
    return out


def conditional_rates(df: DataFrame, condition: Column, label: str) -> DataFrame:
    y = F.col(label).cast("double")
    out = df.agg(F.avg(F.when(condition, y)).alias("rate_inside"),
                 F.avg(F.when(~condition, y)).alias("rate_outside"))
    return out.withColumn("ratio", F.try_divide("rate_inside", "rate_outside"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, long, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
                    for i, (a, b) in enumerate(pairs)])
    both = []
    for i, (a, b) in enumerate(pairs):
        both.append((a, b, i))
        if a != b:
            both.append((b, a, i))
    cells = F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr"))
        for a, b, i in both]))
    return wide.select(cells.alias("s")).select("s.*")


def ranked_correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"c{i}")
                    for i, c in enumerate(columns)])
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.abs(F.col(f"c{i}")).alias("abs_corr"))
        for i, c in enumerate(columns)]))
    return wide.select(cells.alias("s")).select("s.*").orderBy(F.desc("abs_corr"), "column")


# ---- distributions -------------------------------------------------------------------

def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles, max per column (and group), exact."""
    by = list(by)
    keys = [*by, "column"]
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    moments = df.select(*by, cells.alias("c")).select(*by, "c.*").groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by).groupBy(*keys).agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
          for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return moments.join(quartiles, keys).select(
        *keys, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def medians_wide(df: DataFrame, value: str, by: str, label: str, classes: dict) -> DataFrame:
    """Median of a column per group and class, classes as named columns."""
    long = exact_quantiles(df, [value], [0.5], [by, label])
    return long.groupBy(by).agg(*[
        F.max(F.when(F.col(label) == k, F.col("value"))).alias(name) for k, name in classes.items()])


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles, and whiskers at the last value within 1.5 quartile ranges."""
    q = exact_quantiles(df, [value], [0.25, 0.5, 0.75], [by]).groupBy(by).agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
          for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    # Distinct values per group first: the join then sees no repeated rows.
    values = df.select(by, F.col(value).cast("double").alias("v")).groupBy(by, "v").agg(
        F.count("*").alias("n"))
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = (F.col("v") >= F.col("q25") - reach) & (F.col("v") <= F.col("q75") + reach)
    joined = attach(values, q, [by])
    return joined.groupBy(by).agg(
        F.first("q25").alias("q25"), F.first("q50").alias("q50"), F.first("q75").alias("q75"),
        F.min(F.when(inside, F.col("v"))).alias("low_whisker"),
        F.max(F.when(inside, F.col("v"))).alias("high_whisker"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_outliers"))


def histogram(df: DataFrame, value: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins over the whole range; with ``by``, a density per class."""
    v = F.col(value).cast("double")
    span = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    low = span.select("lo").scalar()
    width = span.select(((F.col("hi") - F.col("lo")) / bins).alias("w")).scalar()
    bin_no = F.least(F.floor(F.try_divide(v - low, width)), F.lit(bins - 1))
    keys = [by] if by else []
    out = df.filter(v.isNotNull()).select(*keys, F.coalesce(bin_no, F.lit(0)).cast("int").alias("bin"))
    out = out.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    out = out.withColumn("left_edge", low + F.col("bin") * width)
    if not by:
        return out
    in_class = F.sum("n").over(Window.partitionBy(by))
    return out.withColumn("density", F.try_divide(F.col("n"), in_class * width))


def density_estimate(df: DataFrame, value: Column, by: str, grid: int = 200, bins: int | None = 2048,
                     cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density per class on an even grid.

    Rows are first counted in ``bins`` narrow bins per class; the smoothing then
    runs over the bin counts, whose number does not grow with the data. Without
    ``bins`` it runs over the distinct values with their counts. Bandwidth
    is n^(-1/5) times the sample deviation, the grid reaches ``cut`` bandwidths out.
    """
    rows = df.select(F.col(by).alias("_c"), value.cast("double").alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v"))
    stats = rows.groupBy("_c").agg(
        F.count("*").alias("n"), F.stddev_samp("v").alias("s"), F.min("v").alias("lo"),
        F.max("v").alias("hi")).withColumn("h", F.pow(F.col("n"), F.lit(-0.2)) * F.col("s"))
    placed = attach(rows, stats, ["_c"])
    if bins is None:
        centre = F.col("cell")
        cell = F.col("v")
    else:
        width = (F.col("hi") - F.col("lo")) / bins
        centre = F.col("lo") + (F.col("cell") + 0.5) * width
        cell = F.coalesce(F.least(F.floor(F.try_divide(F.col("v") - F.col("lo"), width)), F.lit(bins - 1)), F.lit(0))
    counts = placed.groupBy("_c", "n", "h", "lo", "hi", cell.alias("cell")).agg(F.count("*").alias("m"))
    start = F.col("lo") - cut * F.col("h")
    step = (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (grid - 1)
    spread = counts.select("_c", "n", "h", "m", centre.alias("x"), start.alias("a"), step.alias("d"),
                           F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    at = F.col("a") + F.col("i") * F.col("d")
    z = (at - F.col("x")) / F.col("h")
    return spread.groupBy("_c", "i").agg(
        F.max(at).alias("x"),
        (F.sum(F.col("m") * F.exp(-z * z / 2)) / F.first(F.col("n") * F.col("h"))
         / F.sqrt(2 * F.pi())).alias("density")).withColumnRenamed("_c", by)


def sorted_labels(df: DataFrame, label: str) -> DataFrame:
    """The sorted list of labels as one array."""
    labels = df.select(label).na.drop().distinct()
    return labels.agg(F.array_sort(F.collect_list(label)).alias("labels"))


def top_groups(df: DataFrame, column: str, k: int) -> DataFrame:
    return (df.groupBy(column).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), column).limit(k))


def preview(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def rate_persistence(train: DataFrame, test: DataFrame, key: str, label: str) -> DataFrame:
    """Positive rate of each key in both periods, for keys seen in both.

    Both tables are reduced to one row per key before they meet.
    """
    a = train.groupBy(key).agg(F.avg(F.col(label).cast("double")).alias("train_rate"))
    b = test.groupBy(key).agg(F.avg(F.col(label).cast("double")).alias("test_rate"))
    return a.join(b, key).na.drop()


def share(top: Column, bottom: Column) -> Column:
    return ratio(top, bottom)
