"""Exact top-k by inner product with MaxScore, shard by shard.

Every shard holds its vectors column by column, one posting column per term (a
component). For a query, a term's bound is the most it can add above the least it
always adds. Terms with the smallest bounds, which together cannot lift a vector
to the current k-th score, are non-essential: the essential columns are traversed
in full, then the others are probed, largest bound first, only for vectors that
can still compete. The shards' answers are merged in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, terms): components as floor(scale * x). Vectors without an id, null, or with a null or
    non-finite component are left out."""
    x = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].alias("terms"))
    sound = F.forall("terms", lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                     & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    return (x.filter(F.col("vec_id").isNotNull() & F.col("terms").isNotNull()).filter(sound)
            .withColumn("terms", F.transform("terms", lambda v: F.floor(v.cast("double") * scale))))


class Shard:
    """Posting columns of one block of vectors; shorter vectors are filled up with zeros."""

    def __init__(self, ids: list[int], vectors: list[list[int]]):
        width = max(map(len, vectors))
        order = np.argsort(np.array(ids, np.int64), kind="stable")
        self.ids = np.array(ids, np.int64)[order]
        exact = max((abs(x) for v in vectors for x in v), default=0)
        self.kind = np.float64 if exact < 1 << 24 else object  # doubles hold sums below 2**53 exactly
        self.columns = np.zeros((width, len(ids)), self.kind)
        for place, k in enumerate(order):
            self.columns[:len(vectors[k]), place] = vectors[k]
        self.low, self.high = (self.columns.min(axis=1), self.columns.max(axis=1)) if width else (np.zeros(0),) * 2

    def best(self, query_id: int, query: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors other than the query's own, ties to smaller ids."""
        width = min(len(query), len(self.columns))
        columns, kind = self.columns[:width], self.kind
        if kind is np.float64 and max(map(abs, query), default=0) * max(width, 1) >= 1 << 29:
            columns, kind = columns.astype(np.int64).astype(object), object
        q = np.array(query[:width], kind)
        others = self.ids != query_id
        ends = np.stack((q * self.low[:width], q * self.high[:width])) if width else np.zeros((2, 0))
        floor, bound = ends.min(axis=0), ends.max(axis=0) - ends.min(axis=0)
        rows = np.flatnonzero(others)
        if len(rows) <= k:
            scores = q @ columns[:, rows] if width else np.zeros(len(rows), kind)
            return self._ranked(rows, scores, k)
        head = rows[:max(4 * k, 256)]
        known = q @ columns[:, head] if width else np.zeros(len(head), kind)
        least = np.sort(known)[::-1][k - 1] if len(head) >= k else None  # the k-th score so far
        order = np.argsort(bound, kind="stable")
        reach = floor.sum() + np.cumsum(bound[order])
        split = int(np.searchsorted(reach.astype(float), float(least), "left")) if least is not None else 0
        idle, essential = order[:split][::-1], order[split:]
        scores = q[essential] @ columns[essential][:, rows] if len(essential) else np.zeros(len(rows), kind)
        rest = (floor + bound)[idle]
        for at in range(0, len(idle), 8):
            competing = scores + rest[at:].sum() >= least
            rows, scores = rows[competing], scores[competing]
            part = idle[at:at + 8]
            scores = scores + q[part] @ columns[part][:, rows]
        return self._ranked(rows, scores, k)

    def _ranked(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        top = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[top]], scores[top]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best of ``vectors``, all if there are fewer.

    Both tables hold (vec_id, terms). Rows with the query's own id take no part. Queries are
    copied to every shard and go through it one batch at a time; vectors are never copied.
    Ties go to the smaller id; a repeated query id with the same terms asks once. Empty
    vectors score 0; empty tables give no rows.
    """
    shards = max(1, -(-vectors.count() // shard_rows))
    stored = vectors.select((F.pmod(F.xxhash64("vec_id"), F.lit(shards))).cast("int").alias("shard"),
                            F.lit(0).alias("kind"), "vec_id", "terms")
    asked = (queries.select("vec_id", "terms").distinct()
             .select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"),
                     "vec_id", "terms"))
    rows = stored.union(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, held, shard = None, [], [], None
        for batch in batches:
            out = []
            for at, kind, vec_id, terms in zip(*(c.to_pylist() for c in batch.columns)):
                if at != number:
                    number, ids, held, shard = at, [], [], None
                if kind == 0:
                    ids.append(vec_id)
                    held.append(terms)
                elif ids:
                    shard = shard or Shard(ids, held)
                    found, scores = shard.best(vec_id, terms, k)
                    out.append((np.full(len(found), vec_id), found, scores.astype(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                                 names=["query_id", "vec_id", "score"])

    found = rows.mapInArrow(run, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def every(vectors: DataFrame, n: int) -> DataFrame:
    """The stated queries: rows whose id is divisible by ``n``."""
    return vectors.filter(F.col("vec_id") % n == 0)


SQL = """
WITH sound AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS terms
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(list_zip(q.terms, v.terms), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM sound q JOIN sound v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""
