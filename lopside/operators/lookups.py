"""Joining derived tables, with the size checked before any broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lopside.session import durable

BROADCAST_ROWS = 200_000


def lookup_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner",
                salts: int = 8) -> DataFrame:
    """Join a table of unique keys to facts whose hottest key may be huge.

    The lookup side is copied ``salts`` times and each fact row picks one copy, so
    a hot key is spread over that many tasks. If the lookup turns out small, AQE
    measures it at run time and broadcasts it instead.
    """
    on = list(on)
    others = [c for c in facts.columns if c not in on]
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in (others or on)]), F.lit(salts)).cast("int")
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn("_salt", spread).join(copies, [*on, "_salt"], how).drop("_salt")


def split_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], count: str, heavy_rows: int = 100_000,
               most: int = 100_000) -> DataFrame:
    """Join a stored table to a lookup of unique keys whose column ``count`` holds the rows of each key in ``facts``.

    Keys of more than ``heavy_rows`` rows and more than the ``most``-th part of all rows are broadcast; they are
    fewer than ``most``, whatever the data. The rest are shuffled by key, and none of them is hot.
    """
    on = list(on)
    limit = max(heavy_rows, facts.count() // most)
    hot = durable(lookup.filter(F.col(count) > limit))
    light = facts.join(F.broadcast(hot.select(*on)), on, "left_anti").join(lookup.filter(F.col(count) <= limit), on)
    heavy = facts.join(F.broadcast(hot), on)
    return light.unionByName(heavy.select(*light.columns))


def _is_small(table: DataFrame, limit: int) -> bool:
    return table.limit(limit + 1).count() <= limit


def attach(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner",
           limit: int = BROADCAST_ROWS) -> DataFrame:
    """Add the columns of a derived lookup table with unique keys.

    The table is computed once, counted, and broadcast only if it is within
    ``limit`` rows. Beyond it the facts are salted and joined by a shuffle.
    """
    lookup = durable(lookup)
    if _is_small(lookup, limit):
        return facts.join(F.broadcast(lookup), list(on), how)
    return lookup_join(facts, lookup, on, how)


def keep_matching(facts: DataFrame, keys: DataFrame, on: Sequence[str],
                  limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose key is in a table of keys, filtered before any shuffle if it is small."""
    if _is_small(keys, limit):
        return facts.join(F.broadcast(keys), list(on), "left_semi")
    return facts.join(keys, list(on), "left_semi")


def small_rows(df: DataFrame, limit: int = 10_000) -> list:
    """Read a table that must be small (class lists, categories) to the driver."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; this step needs a small table")
    return rows
