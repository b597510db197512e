"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment.

Items are partitioned by size (powers of two). For each partition a document is
read as overlapping windows of about the size of its items, so an item inside even
a very long document makes up a fair part of some window, and their MinHash values
agree in at least one of many coordinates. Two Bloom filters of bounded size keep
windows and shingles that no item has inside the task that reads the document; what
remains is joined with the items' values, and each candidate pair is counted exactly.
An item of fewer than five words is a single shingle; runs of as many words are then taken
from the documents as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lopside.llm.common import flat_bytes, mixed, shingles, small_batches, stored, text_bytes, text_slices, word_spans

WORDS = 5
COORDINATES = 64
_FACTORS = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
MOST_BITS = 1 << 26
_PROBES = 4


def _key(size_class: int, coordinate: int, values: np.ndarray) -> np.ndarray:
    return mixed(values ^ mixed(np.array([size_class * COORDINATES + coordinate + 1], np.uint64)))


def _probes(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    step = mixed(keys) | np.uint64(1)
    return [(keys + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(_PROBES)]


def _passes(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which keys may be in a Bloom filter of 64-bit words."""
    ok = np.ones(len(keys), bool)
    for slot in _probes(keys, 64 * len(words)):
        ok &= (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
    return ok


def item_table(items: DataFrame) -> DataFrame:
    """(item_id, words, shingles, signature): distinct word shingles and the keys of their MinHash values.

    Items without words are left out; an item of fewer than five words has one shingle. ``words`` is their
    number, at most five.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "_text"):
            data, offsets = flat_bytes(batch.column("_text"))
            hashes, owner = shingles(data, offsets, WORDS)
            words = np.bincount(word_spans(data, offsets)[2], minlength=batch.num_rows)
            ids, out = batch.column("item_id").to_pylist(), ([], [], [], [])
            for k in np.unique(owner):
                own = np.unique(hashes[owner == k])
                size_class = len(own).bit_length() - 1
                least = np.array([(own * f).min() for f in _FACTORS], np.uint64)
                sign = np.concatenate([_key(size_class, i, least[i:i + 1]) for i in range(COORDINATES)])
                for column, value in zip(out, (ids[k], min(int(words[k]), WORDS), own.view(np.int64).tolist(), sign.view(np.int64).tolist())):
                    column.append(value)
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], lists),
                                              pa.array(out[3], lists)], names=["item_id", "words", "shingles", "signature"])

    rows = items.select(items["item_id"].cast("long").alias("item_id"), text_bytes(items).alias("_text"))
    return rows.mapInArrow(run, "item_id long, words int, shingles array<long>, signature array<long>")


def bloom(values: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter of a column of 64-bit keys; at most MOST_BITS bits reach the driver, however many keys."""
    count = values.count()
    bits = min(MOST_BITS, 1 << max(16, (64 * count).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.unique(np.concatenate(_probes(batch.column(0).to_numpy().view(np.uint64), bits)))
            bit = (np.uint64(1) << (slots & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((slots >> np.uint64(6)).astype(np.int64)), pa.array(bit)], names=["at", "bit"])

    found = (values.select(F.col(column).alias("v")).mapInArrow(run, "at long, bit long")
             .groupBy("at").agg(F.expr("bit_or(bit)").alias("bits")).collect())
    words = np.zeros(bits // 64, np.uint64)
    for row in found:
        words[row["at"]] = np.uint64(row["bits"] & 0xFFFFFFFFFFFFFFFF)
    return words


def _windows(owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of consecutive blocks of ``length`` shingles in each text, the text of each, and which have a successor."""
    count = np.bincount(owner)
    first = np.cumsum(count) - count
    per_text = -(-count // length)
    text = np.repeat(np.arange(len(count)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    return first[text] + number * length, text, np.append(text[1:] == text[:-1], False) if len(text) else text.astype(bool)


def survivors(docs: DataFrame, classes: list[int], short: list[int], signatures: np.ndarray, known: np.ndarray) -> DataFrame:
    """(doc_id, _key, keys, shared): documents with a window value that an item may have, and their shared shingles.

    ``short``: the numbers of words, below five, that items have.
    """
    context = docs.sparkSession.sparkContext
    filters = context.broadcast((signatures, known))  # at most MOST_BITS bits each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign_filter, known_filter = filters.value
        lists = pa.list_(pa.int64())
        for batch in text_slices(batches, "_text"):
            data, offsets = flat_bytes(batch.column("_text"))
            hashes, owner = shingles(data, offsets, WORDS)
            if not len(hashes):
                continue
            blocks = {c: _windows(owner, 2 << c) for c in classes}
            found: dict[int, list[np.ndarray]] = {}
            for i, factor in enumerate(_FACTORS):
                values = hashes * factor
                for c, (starts, text, followed) in blocks.items():
                    least = np.minimum.reduceat(values, starts)
                    least = np.where(followed, np.minimum(least, np.append(least[1:], least[-1:])), least)
                    keys = _key(c, i, least)
                    for k in np.flatnonzero(_passes(keys, sign_filter)):
                        found.setdefault(int(text[k]), []).append(keys[k])
            shared = _passes(hashes, known_filter)
            hits, hit_owner = hashes[shared], owner[shared]
            for words in short:  # a run of an item's words is all of the item: its own value in every coordinate
                runs, run_owner = shingles(data, offsets, words)
                keys = _key(0, 0, runs * _FACTORS[0])
                may = _passes(runs, known_filter) & _passes(keys, sign_filter)
                at = np.flatnonzero(may)
                at = at[np.lexsort((runs[at], run_owner[at]))]
                at = at[np.append(True, (np.diff(run_owner[at]) != 0) | (runs[at][1:] != runs[at][:-1]))[:len(at)]]  # each run once a text
                for k in at:
                    found.setdefault(int(run_owner[k]), []).append(keys[k])
                hits, hit_owner = np.append(hits, runs[at]), np.append(hit_owner, run_owner[at])
            if not found:
                continue
            order = np.argsort(hit_owner, kind="stable")
            hits, hit_owner = hits[order], hit_owner[order]
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("_key").to_pylist()
            rows = sorted(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[k] for k in rows], pa.int64()), pa.array([keys[k] for k in rows], pa.int64()),
                 pa.array([np.unique(np.array(found[k], np.uint64)).view(np.int64) for k in rows], lists),
                 pa.array([np.unique(hits[np.searchsorted(hit_owner, k):np.searchsorted(hit_owner, k, "right")]).view(np.int64)
                           for k in rows], lists)], names=["doc_id", "_key", "keys", "shared"])

    rows = row_key(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "_key", text_bytes(docs).alias("_text"))
    return rows.mapInArrow(run, "doc_id long, _key long, keys array<long>, shared array<long>")


def row_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_key", F.xxhash64(docs["doc_id"].cast("string"), F.coalesce(docs["text"].cast("string"), F.lit(""))))


def matches(docs: DataFrame, items: DataFrame, containment: float = 0.8) -> DataFrame:
    """(doc_id, _key, item_id, n_shared, n_item, containment): items of which a document has most shingles.

    Shingles are runs of five lower-cased words; ``containment`` is the least share of an item's
    distinct shingles that must stand in the document. An item of fewer than five words is one shingle, and
    matches every document in which its words follow each other. Null or empty texts match nothing; repeated
    item ids are items of their own only if their texts differ; repeated documents are reported once.
    Empty tables give no rows.
    """
    small_batches(docs.sparkSession)
    table = stored(item_table(items).distinct())
    n = F.size("shingles")
    classes = [r[0] for r in table.select(F.floor(F.log2(n.cast("double"))).cast("int")).distinct().collect()]  # powers of two: few
    short = [r[0] for r in table.filter(F.col("words") < WORDS).select("words").distinct().collect()]  # four at most
    signatures = table.select("item_id", F.col("shingles").alias("of"), F.explode("signature").alias("key"))
    found = stored(survivors(docs, sorted(classes), sorted(short), bloom(signatures, "key"),
                             bloom(table.select(F.explode("shingles").alias("s")).distinct(), "s")).dropDuplicates(["doc_id", "_key"]))
    items_by_hash = table.select("item_id", "shingles", F.xxhash64("item_id", "shingles").alias("_item"))
    pairs = (found.select("doc_id", "_key", F.explode("keys").alias("key"))
             .join(signatures.select(F.xxhash64("item_id", "of").alias("_item"), "key").distinct(), "key")
             .select("doc_id", "_key", "_item").distinct())
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_found"))
    counted = (pairs.join(found.select(F.col("doc_id").alias("_doc"), F.col("_key").alias("_found"), "shared"), same)
               .join(items_by_hash, "_item")
               .select("doc_id", "_key", "item_id", F.size(F.array_intersect("shared", "shingles")).alias("n_shared"),
                       F.size("shingles").alias("n_item")))
    return counted.withColumn("containment", F.col("n_shared") / F.col("n_item")).filter(F.col("containment") >= containment)


def clean(docs: DataFrame, items: DataFrame, containment: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    leaks = stored(matches(docs, items, containment).select(F.col("doc_id").alias("_leak"), F.col("_key").alias("_of")).distinct())
    rows = row_key(docs)
    return rows.join(leaks, rows["doc_id"].cast("long").eqNullSafe(leaks["_leak"]) & (rows["_key"] == leaks["_of"]),
                     "left_anti").drop("_key")


SQL = """
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0b\\x0c\\r]+'),
    lambda w: w <> '') AS w FROM texts),
shingle AS (
  SELECT DISTINCT kind, id, array_to_string(w[k : k + least(len(w), 5) - 1], ' ') AS s
  FROM words, unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 4, 1) + 1 END)) AS r(k)
  UNION
  SELECT kind, id, array_to_string(w[k : k + n - 1], ' ')
  FROM words, (SELECT DISTINCT len(w) AS n FROM words WHERE kind = 'i' AND len(w) BETWEEN 1 AND 4) AS short,
    unnest(range(1, greatest(len(w) - n + 2, 1))) AS r(k) WHERE kind = 'd'),
size AS (SELECT id, count(*) AS n FROM shingle WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, CAST(count(*) AS INTEGER) AS n_shared, CAST(any_value(n) AS INTEGER) AS n_item,
       count(*) / CAST(any_value(n) AS DOUBLE) AS containment
FROM shingle d JOIN shingle i ON d.kind = 'd' AND i.kind = 'i' AND d.s = i.s JOIN size ON size.id = i.id
GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(n)
"""
