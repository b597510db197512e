"""Registry filled by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lopside.sources.standins import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
COVERS: dict[str, str] = {}
HOLDS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def query(name: str, covers: str, sql: str | None = None, holds: Callable[[DataFrame], DataFrame] | None = None):
    """Register ``f(tables) -> DataFrame`` under a name.

    the result of any fitted model; the tests look at them.
    """
    def register(f):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(Tables(spark, folder))

        run.__name__ = name
        run.__doc__ = f.__doc__
        QUERIES[name] = run
        COVERS[name] = covers
        if sql is not None:
            SQL[name] = with_views(sql)
        if holds is not None:
            HOLDS[name] = holds
        return f
    return register


def r6(c: Column | str) -> Column:
    """Six decimals: sums of doubles differ by their order in the last digits."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else df


def held_out_sql(table: str, label: str, key: str, share: float = 0.2) -> str:
    """CTE ``flagged``: the table with the stratified ``in_test`` flag."""
    return f"""flagged as (select *, row_number() over (partition by {label} order by md5(concat('42:', cast({key} as varchar))))
    <= round({share}e0 * count(*) over (partition by {label})) as in_test from {table})"""


def sound_results(results: DataFrame, *keys: str) -> DataFrame:
    """What must hold for any fitted model's results, beside its name and the rows it was tested on."""
    p, r = F.col("precision"), F.col("recall")
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return results.select(
        *keys, F.col("n_test").cast("bigint").alias("n_test"), (F.abs(F.col("f1") - f1) < 1e-9).alias("f1_follows"),
        F.col("roc_auc").between(0, 1).alias("auc_in_range"),
        (F.col("baseline_accuracy") >= 0.5).alias("baseline_is_majority"))


def double_list(values) -> str:
    """SQL list of doubles, written so that they stay doubles."""
    return "[" + ", ".join(f"{v!r}e0" for v in values) + "]"
