"""Near-duplicates by DartMinHash signatures, banded joins and exact weighted similarity.

A document is a weighted set: its five-word shingles with their counts. Each
element's weight axis is cut into regions that double in width; darts are thrown
into a region by a hashed Poisson process, so equal elements get equal darts in
every document. Those below the element's weight count, and the earliest of each
coordinate is the document's MinHash value: two documents agree in a coordinate
with a probability of their weighted Jaccard similarity.

Texts that are equal become one node. Nodes that share a band are compared with
the band's first node, and later with further ones, until all nodes of a band are
linked or compared; a link needs the exact similarity. Groups of linked nodes are
the classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lopside.llm.common import flat_bytes, mixed, shingles, small_batches, stored, text_bytes, text_slices
from lopside.llm.decontaminate import _passes, bloom
from lopside.llm.graph import components, relabelled

WORDS, BANDS, ROWS = 5, 20, 4
SMALL_BUCKET = 16
BLOCK_NODES, BLOCK_BYTES = 256, 4 << 20
_STEP = np.uint64(0xD1B54A32D192ED03)


def _steps(n: int) -> np.uint64:
    return np.uint64(n * int(_STEP) & 0xFFFFFFFFFFFFFFFF)


def weighted(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with their counts, sorted."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])) if len(hashes) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return hashes[first], owner[first], np.diff(np.append(first, len(hashes))).astype(float)


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def darts(element: np.ndarray, weight: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(element number, time, dart id) of all darts below each element's weight and before its time."""
    out, region = [], 0
    while True:
        low, width = 2.0 ** region - 1, 2.0 ** region
        rows = np.flatnonzero(weight > low)
        if not len(rows):
            break
        seed = mixed(element[rows] + _steps(region))
        time, throw = np.zeros(len(rows)), 0
        while len(rows):
            throw += 1
            dart = mixed(seed + _steps(throw))
            time = time - np.log(_unit(dart)) / width
            alive = time < until[rows]
            rows, seed, time, dart = rows[alive], seed[alive], time[alive], dart[alive]
            ident = mixed(dart + _STEP)
            hit = low + width * _unit(ident) < weight[rows]
            out.append((rows[hit], time[hit], mixed(ident + _STEP)[hit]))
        region += 1
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.uint64))


def signatures(element: np.ndarray, owner: np.ndarray, weight: np.ndarray, texts: int, size: int) -> np.ndarray:
    """The id of the earliest dart of each of ``size`` coordinates, for texts 0 to ``texts`` (0 where a text is empty)."""
    out = np.zeros((texts, size), np.uint64)
    total = np.bincount(owner, weights=weight, minlength=texts)
    reach = size * (np.log(size) + 2) / np.maximum(total, 1e-300)
    todo = total > 0
    while todo.any():
        rows = np.flatnonzero(todo[owner])
        at, time, dart = darts(element[rows], weight[rows], reach[owner[rows]])
        slot = owner[rows][at] * size + (dart % np.uint64(size)).astype(np.int64)
        order = np.lexsort((dart, time, slot))
        slot, dart = slot[order], dart[order]
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, np.int64)
        filled = np.zeros((texts, size), bool)
        filled.reshape(-1)[slot[first]] = True
        done = todo & filled.all(axis=1)
        keep = done[slot[first] // size]
        out.reshape(-1)[slot[first][keep]] = dart[first][keep]
        todo &= ~done
        reach = reach * 2
    return out


def bands(signs: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of ROWS coordinates."""
    keys = np.zeros((len(signs), signs.shape[1] // ROWS), np.uint64)
    for band in range(keys.shape[1]):
        key = np.full(len(signs), np.uint64(band + 1))
        for k in range(ROWS):
            key = mixed(key * _STEP + signs[:, band * ROWS + k])
        keys[:, band] = key
    return keys


def expanded(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A multiset as a sorted set: the second and later copies of an element get hashes of their own."""
    n = count.astype(np.int64)
    copy = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    repeated = np.repeat(hashes, n)
    return np.sort(np.where(copy > 0, mixed(repeated + copy.astype(np.uint64) * _STEP), repeated))


def _node(text: bytes) -> int:
    return int.from_bytes(hashlib.sha256(text).digest()[:8], "big") >> 4


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, node, keys): 60 bits of the text's SHA-256, and its band keys (none for a text without words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "_text", 2 << 20):
            texts = batch.column("_text")
            data, offsets = flat_bytes(texts)
            element, owner, weight = weighted(*shingles(data, offsets, WORDS))
            keys = bands(signatures(element, owner, weight, len(texts), BANDS * ROWS)).view(np.int64)
            some = np.bincount(owner, minlength=len(texts)) > 0
            at = np.append(0, np.cumsum(np.where(some, BANDS, 0))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([_node(t.as_py()) for t in texts], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(keys[some].reshape(-1)))], names=["doc_id", "node", "keys"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_bytes(docs).alias("_text"))
    return rows.mapInArrow(run, "doc_id long, node long, keys array<long>")


def shingle_sets(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(node, items): the expanded shingles of nodes that pass the filter, sorted 64-bit, one row a node."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)  # a Bloom filter of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "_text", 2 << 20):
            nodes = np.array([_node(t.as_py()) for t in batch.column("_text")], np.int64)
            _, first = np.unique(nodes, return_index=True)
            rows = first[_passes(nodes[first].view(np.uint64), shared.value)]
            if not len(rows):
                continue
            texts = batch.column("_text").take(pa.array(rows))
            element, owner, count = weighted(*shingles(*flat_bytes(texts), WORDS))
            cut = np.searchsorted(owner, np.arange(len(rows) + 1))
            sets = [expanded(element[a:b], count[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[rows]), pa.array(sets, pa.binary())], names=["node", "items"])

    return (docs.select(text_bytes(docs).alias("_text")).mapInArrow(run, "node long, items binary")
            .groupBy("node").agg(F.first("items").alias("items")))


def similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose exact weighted Jaccard similarity reaches ``threshold``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= threshold * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    size = F.length("x") / F.length("y")
    rows = (pairs.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
            .filter(size.between(threshold, 1 / threshold)))
    return rows.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def linked(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(node, label) of all nodes with a link, from the bands' members (key, node).

    First each member meets the least node of its band. Of the bands that then still hold more than
    one component, small ones compare all pairs of different components. The members of large ones
    are put together where bands overlap and compared block against block, each pair once and without
    a row for each pair. So no pair that shares a band is left out, but for those already joined.
    """
    pivots = members.groupBy("key").agg(F.min("node").alias("a"))
    waiting = stored(members.join(pivots, "key").filter("node <> a"))
    links = stored(similar(stored(waiting.select("a", F.col("node").alias("b")).distinct()), sets, threshold))
    labels = stored(components(links))
    now = stored(waiting.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label")))
    open_keys = (now.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("least"), F.max("label").alias("most"))
                 .filter("least <> most").select("key", "n"))
    now = stored(now.join(open_keys, "key"))
    small = now.filter(F.col("n") <= SMALL_BUCKET).drop("n")
    other = small.select("key", F.col("node").alias("a"), F.col("label").alias("_label"))
    pairs = small.join(other, "key").filter("a < node and _label <> label").select("a", F.col("node").alias("b"))
    links = similar(stored(pairs.distinct()), sets, threshold)
    links = stored(links.union(linked_in_blocks(now.filter(F.col("n") > SMALL_BUCKET), sets, threshold)))
    return labels if links.isEmpty() else relabelled(labels, links)


def linked_in_blocks(large: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The similar pairs (a, b) of different labels among nodes of bands (key, node, label) that overlap."""
    hubs = large.groupBy("key").agg(F.min("node").alias("a"))
    together = components(large.join(hubs, "key").select("a", F.col("node").alias("b")).distinct())
    nodes = stored(large.select("node", "label").distinct().join(together.select("node", F.col("label").alias("area")), "node")
                   .join(sets.select("node", F.length("items").alias("size")), "node"))
    areas = (nodes.groupBy("area").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.min("label").alias("least"),
                                       F.max("label").alias("most")).filter("least <> most")
             .select("area", F.ceil(F.greatest(F.col("n") / BLOCK_NODES, F.col("bytes") / BLOCK_BYTES)).alias("blocks")))
    placed = nodes.join(areas, "area").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    copies = placed.withColumn("_with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    copies = copies.select("node", "label", "area", "block", F.least("block", "_with").alias("low"), F.greatest("block", "_with").alias("high"))
    rows = copies.join(sets, "node").repartition("area", "low", "high").sortWithinPartitions("area", "low", "high", "node")

    def compare(group: list[tuple]) -> Iterator[tuple[int, int]]:
        node, label, block = (np.array([g[k] for g in group], np.int64) for k in range(3))
        size = np.array([len(g[3]) // 8 for g in group])
        _, item, often = np.unique(np.frombuffer(b"".join(g[3] for g in group), np.uint64), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(group)), size)
        useful = often[item] > 1
        _, item = np.unique(item[useful], return_inverse=True)
        held = np.zeros((len(group), int(item.max()) + 1 if len(item) else 1), np.float32)
        held[owner[useful], item] = 1
        common = held @ held.T
        hit = common >= threshold * (size[:, None] + size[None, :] - common)
        hit &= label[:, None] != label[None, :]
        if block.min() != block.max():
            hit &= block[:, None] != block[None, :]  # pairs within a block have a group of their own
        a, b = np.nonzero(np.triu(hit, 1))
        yield from zip(node[a].tolist(), node[b].tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = ("area", "low", "high", "node", "label", "block", "items")
        every = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in order)))
        for _, group in groupby(every, key=lambda row: row[:3]):
            group = [row[3:] for row in group]
            found = list(compare(group)) if len({row[1] for row in group}) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, node, class_id): one row per document; ``class_id`` is the least doc_id of its class.

    Classes are the groups joined by links: equal texts, or a weighted Jaccard similarity of
    five-word shingles (lower case, split at white space) of at least ``threshold``. Texts of
    fewer than five words are one shingle; null and empty texts are equal to each other, and texts
    of white space only have no links but to equal texts. Null ids come last in a class; a class of
    null ids alone has a null class_id. Repeated rows give a row each. Empty table: no rows.
    """
    small_batches(docs.sparkSession)
    rows = stored(sketched(docs))
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("keys").alias("keys"))
    keys = stored(nodes.select("node", "least", "keys"))
    banded = keys.select("node", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members = stored(banded.join(shared, "key").select("key", "node"))
    if members.isEmpty():
        labels = members.select("node", F.col("node").alias("label"))
    else:
        sets = stored(shingle_sets(docs, bloom(members.select("node").distinct(), "node")))
        labels = stored(linked(members, sets, threshold))
    named = keys.select("node", "least").join(labels, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
    named = stored(named)
    classes = stored(named.groupBy("label").agg(F.min("least").alias("class_id")))
    named = stored(named.join(classes, "label").select("node", "class_id"))
    return rows.select("doc_id", "node").join(named, "node").select("doc_id", "node", "class_id")


def first_of_each(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` with all their columns, one for each class: that of the least doc_id."""
    found = stored(near_duplicates(docs, threshold))
    ranked = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    by_class = F.coalesce(F.col("class_id").cast("string"), F.concat(F.lit("node "), F.col("node").cast("string")))
    kept = (found.groupBy(by_class.alias("class")).agg(F.min(ranked).alias("first"))
            .select(F.col("first.doc_id").alias("_id"), F.col("first.node").alias("_node")))
    names = docs.columns
    rows = docs.withColumn("_of", node_of(F.col("text")))
    kept_keys = kept.select("_id", "_node")
    out = rows.join(kept_keys, rows["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_node")), "left_semi")
    if not found.groupBy("doc_id", "node").count().filter("count > 1").isEmpty():  # the same row more than once
        out = out.dropDuplicates(["doc_id", "_of"])
    return out.select(*names)


def node_of(text):
    """The node of a text: 60 bits of its SHA-256, null as empty."""
    return F.conv(F.substring(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256), 1, 15), 16, 10).cast("long")
