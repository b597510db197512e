"""One-hot and scaled columns as plain expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lopside.operators.lookups import small_rows


def categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted values of each categorical column; each becomes a column of the design, so they must be few."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    found = df.select(pairs.alias("p")).select("p.*").filter("value is not null").distinct()
    out: dict[str, list[str]] = {c: [] for c in columns}
    for row in small_rows(found, limit=100_000 * len(columns)):
        out[row["column"]].append(row["value"])
    return {c: sorted(v) for c, v in out.items()}


def dummies(column: str, values: Sequence[str]) -> list[Column]:
    """0/1 columns for all values but the first; unseen values are all 0."""
    return [F.coalesce((F.col(column) == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{column}_{v}")
            for v in values[1:]]


def dummy_names(column: str, values: Sequence[str]) -> list[str]:
    return [f"{column}_{v}" for v in values[1:]]


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation of numeric columns, long."""
    wide = df.agg(*[f(F.col(c).cast("double")).alias(f"{p}{i}") for i, c in enumerate(columns)
                    for p, f in (("m", F.avg), ("s", F.stddev_pop))])
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
        for i, c in enumerate(columns)]))
    return wide.select(cells.alias("s")).select("s.*")


def scaled(column: str, mean: float, std: float) -> Column:
    """Centred and divided by the population deviation; a constant column becomes 0."""
    return ((F.col(column).cast("double") - F.lit(mean)) / F.lit(std if std else 1.0))


def standardise(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Scale columns by moments taken from ``fitted_on`` (default: the same table)."""
    found = {r["column"]: r for r in moments(fitted_on or df, columns).collect()}
    return df.withColumns({c: scaled(c, found[c]["mean"], found[c]["std"]) for c in columns})
