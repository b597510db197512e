"""Hard negatives: windows of scores below an anchor's positives, found through zone maps.

All rows are sorted by label and by their place on a Hilbert curve, and written as Parquet
blocks of one label with the least and greatest value of each dimension (zone maps). An
anchor's inner product with any row of a block lies between two sums over these ends, so
the zone maps alone say which blocks an anchor can need: for its positives, blocks of its
label that can reach the best scores of its own block; for its negatives, blocks of other labels
whose interval meets one of its windows. Only these blocks are read. Anchors travel in batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lopside.llm.common import stored
from lopside.llm.whitening import FARTHEST, dense

ROWS = ("kind int, shard int, number int, label long, n int, low array<long>, high array<long>, ids binary, x binary, floors binary")
_NAMES = [c.split()[0] for c in ROWS.split(", ")]
_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
NONE = -(1 << 62)  # the least score that takes part
_EXACT = 1 << 53


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``cells`` (whole numbers below 2**bits) on the Hilbert curve through all cells.

    At most 62 bits in all. Neighbours on the curve differ by one in one dimension.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):  # undo the turns and mirrors of each level
        flip, low = (x >> bit) & 1, (1 << bit) - 1
        for d in range(dims):
            set_ = flip[d] if d else (x[0] >> bit) & 1
            swap = np.where(set_ == 1, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(set_ == 1, low, swap)
            x[d] ^= swap if d else 0
    for d in range(1, dims):  # Gray code over the dimensions
        x[d] ^= x[d - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> bit) & 1)
    return key


def quantised(vectors: DataFrame, scale: int = 256, moved: int = 7, labels: int = 10) -> DataFrame:
    """(vec_id, label, x): components as floor(scale * x), the label of every ``moved``-th id shifted by one.

    Rows without an id, label or vector, or with a null or non-finite component, are left out.
    """
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].cast("long").alias("label"),
                          vectors["embedding"].alias("x")).dropna()
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                     & (F.abs(v.cast("double")) < F.lit(float("inf"))))

    def whole(v: Column) -> Column:
        return F.floor(F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), v.cast("double") * scale)))

    label = F.when(F.col("vec_id") % moved == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.filter(sound).select("vec_id", label.alias("label"), F.transform("x", whole).alias("x"))


def spread(rows: DataFrame) -> list[tuple[int, int, int, float]]:
    """(dimension, least, greatest, variance) of each dimension; it steers the curve, not the result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = max(map(len, batch.column("x")), default=0)
            x = dense(batch.column("x"), width, 0)
            f = x.astype(float)
            yield pa.RecordBatch.from_pydict({
                "d": pa.array(np.arange(width), pa.int32()), "n": pa.array(np.full(width, len(x)), pa.int64()), "low": x.min(axis=0, initial=0),
                "high": x.max(axis=0, initial=0), "s": f.sum(axis=0), "ss": (f * f).sum(axis=0)})

    found = (rows.mapInArrow(run, "d int, n long, low long, high long, s double, ss double").groupBy("d")
             .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("s").alias("s"), F.sum("ss").alias("ss")))
    return [(r.d, r.low, r.high, r.ss / r.n - (r.s / r.n) ** 2) for r in found.orderBy("d").collect()]


def _small(x: np.ndarray) -> bytes:
    most = int(np.abs(x).max(initial=0))
    return x.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def _matrix(data: bytes, n: int, width: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // max(1, n * width)}").reshape(n, width).astype(np.int64)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exact: doubles where they hold them, Python's integers elsewhere."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    kind = float if most < _EXACT else object
    return a.astype(kind) @ b.astype(kind).T


def reach(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest inner product that each row of ``x`` can have with any row between ``low`` and ``high``."""
    up, down = np.maximum(x, 0), np.minimum(x, 0)
    return scores(up, low) + scores(down, high), scores(up, high) + scores(down, low)


def blocks(rows: DataFrame, keep: int, every: int = 100, block_rows: int = 512, batch_rows: int = 256, shard_values: int = 1 << 19,
           dims: int = 15, bits: int = 4) -> tuple[DataFrame, int]:
    """All rows as blocks of one label along the curve (kind 0), and the anchors in batches (kind 1); and their width.

    A shard is a range of the order, of about ``shard_values`` components; rows alike in
    label and place are dealt out by their ids, so no group of copies must stay together. ``floors``
    holds each anchor's ``keep``-th best score among the other rows of its own block.
    """
    ends = spread(rows)
    width = max(1, len(ends))
    axes = sorted(sorted(ends, key=lambda e: -e[3])[:dims])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = dense(batch.column("x"), width, 0)
            cells = np.stack([np.clip((x[:, d].astype(float) - low) / max(1, high - low + 1) * (1 << bits), 0, (1 << bits) - 1)
                              for d, low, high, _ in axes], 1) if axes else np.zeros((len(x), 1))
            yield batch.append_column("place", pa.array(hilbert(cells, bits)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, count = TaskContext.get().partitionId(), [0, 0]
        label, ids, held = None, [], []
        anchors: list[list] = [[], [], []]
        last: list = []

        def row(kind: int, x: np.ndarray, own: list, floors: list) -> tuple:
            count[kind] += 1
            return (kind, shard, count[kind] - 1, label, len(x), x.min(axis=0).tolist(), x.max(axis=0).tolist(),
                    np.array(own, "<i8").tobytes(), _small(x), np.array(floors, "<i8").tobytes())

        def batch_of() -> Iterator[tuple]:
            if anchors[0]:
                yield row(1, np.stack(anchors[1]), anchors[0], anchors[2])
                for part in anchors:
                    part.clear()

        def block_of() -> Iterator[tuple]:
            if not ids:
                return
            x, own = np.stack(held), np.array(ids, np.int64)
            yield row(0, x, ids, [])
            for k in np.flatnonzero(own % every == 0):
                if last and last[0] == own[k] and last[1] == label and (last[2] == x[k]).all():
                    continue  # a repeated row asks once
                last[:] = own[k], label, x[k]
                s = np.sort(scores(x[k:k + 1], x[own != own[k]])[0])
                floor = int(s[-keep]) if len(s) >= keep else NONE
                anchors[0].append(int(own[k]))
                anchors[1].append(x[k])
                anchors[2].append(max(NONE, min(floor, -NONE)))
                if len(anchors[0]) >= batch_rows:
                    yield from batch_of()
            ids.clear()
            held.clear()

        def table(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _TYPES)], _NAMES)

        for batch in batches:
            x = dense(batch.column("x"), width, 0)
            for k, (vec_id, own) in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist())):
                new = label is not None and own != label
                if new or len(ids) >= block_rows:
                    found = [*block_of(), *(batch_of() if new else ())]
                    if found:
                        yield table(found)
                label = own
                ids.append(vec_id)
                held.append(x[k])
        found = [*block_of(), *batch_of()]
        if found:
            yield table(found)

    shards = max(1, -(-rows.count() * width // shard_values))
    # Equal rows beyond a block's worth are one place on the curve; the hash of nothing but their position parts them.
    placed = (rows.mapInArrow(place, "vec_id long, label long, x array<long>, place long")
              .withColumn("copy", F.monotonically_increasing_id()))
    order = ["label", "place", "vec_id", "copy"]
    return placed.repartitionByRange(shards, *order).sortWithinPartitions("label", "place", "vec_id", "x").mapInArrow(pack, ROWS), width


def _windows(positive: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The integer scores s with least * p <= 100 * s <= most * p, for each positive score p."""
    p = positive.astype(object)
    return -((-least * p) // 100), (most * p) // 100


def _read(asked: DataFrame, table: DataFrame, width: int, same_label: bool, k: int) -> DataFrame:
    """Answers (batch, row, slot, vec_id, score): for each window of each anchor its best ``k`` rows of each shard.

    ``asked``: batches with ``lows`` and ``highs``, one pair of ends for each anchor and slot. First the zone maps
    choose, for each shard, which anchors need which blocks; then only these blocks are read.
    """
    spark = table.sparkSession
    zones = table.filter("kind = 0").select("shard", "number", "label", "low", "high")
    last = zones.agg(F.max("shard")).head()[0]
    if last is None:
        return spark.createDataFrame([], "batch long, row int, slot int, vec_id long, score long")
    every = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last))))
    none = F.lit(None)

    def bounds(x: np.ndarray, lows: np.ndarray, highs: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        least, most = reach(x, low, high)
        # (anchors, blocks): whether the interval meets a window.
        return ((most[:, :, None] >= lows[:, None, :]) & (least[:, :, None] <= highs[:, None, :])).any(axis=2)

    def slots(batch: pa.RecordBatch, at: int) -> tuple:
        n = batch.column("n")[at].as_py()
        x = _matrix(batch.column("x")[at].as_py(), n, width)
        ids = np.frombuffer(batch.column("ids")[at].as_py(), "<i8")
        lows, highs = (np.frombuffer(batch.column(c)[at].as_py(), "<i8").reshape(n, -1) for c in ("lows", "highs"))
        return x, ids, lows, highs

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, ready = None, [], None
        for batch in batches:
            out = []
            for at, (number, kind) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("kind").to_pylist())):
                if number != shard:
                    shard, held, ready = number, [], None
                if kind == 0:
                    held.append([batch.column(c)[at].as_py() for c in ("number", "label", "low", "high")])
                    continue
                if not held:
                    continue
                if ready is None:
                    held.sort()
                    ready = [np.array(c, np.int64) for c in zip(*held)]
                x, _, lows, highs = slots(batch, at)
                label = batch.column("label")[at].as_py()
                fits = (ready[1] == label) if same_label else (ready[1] != label)
                need = np.zeros((len(x), len(fits)), bool)
                if fits.any():
                    need[:, fits] = bounds(x, lows, highs, ready[2][fits], ready[3][fits])
                if need.any():
                    picked = np.flatnonzero(need.any(axis=0))
                    out.append((number, batch.column("batch")[at].as_py(), ready[0][picked].tolist(), np.packbits(need[:, picked]).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.binary()))],
                    ["shard", "batch", "picked", "need"])

    both = (zones.select("shard", F.lit(0).alias("kind"), "number", "label", "low", "high", none.cast("long").alias("batch"), none.cast("int").alias("n"),
                         *[none.cast("binary").alias(c) for c in ("ids", "x", "lows", "highs")])
            .unionByName(every.select("shard", F.lit(1).alias("kind"), none.cast("int").alias("number"), "label", none.cast("array<long>").alias("low"),
                                      none.cast("array<long>").alias("high"), "batch", "n", "ids", "x", "lows", "highs")))
    chosen = stored(both.repartition(last + 1, "shard").sortWithinPartitions("shard", "kind")
                    .mapInArrow(choose, "shard int, batch long, picked array<int>, need binary"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, {}
        for batch in batches:
            out = []
            for at, (number, kind) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("kind").to_pylist())):
                if number != shard:
                    shard, held = number, {}
                if kind == 0:
                    n = batch.column("n")[at].as_py()
                    x = _matrix(batch.column("x")[at].as_py(), n, width)
                    held[batch.column("number")[at].as_py()] = (np.frombuffer(batch.column("ids")[at].as_py(), "<i8"), x)
                    continue
                x, ids, lows, highs = slots(batch, at)
                picked = batch.column("picked")[at].as_py()
                need = np.unpackbits(np.frombuffer(batch.column("need")[at].as_py(), np.uint8), count=len(x) * len(picked)).reshape(len(x), -1)
                found = _best(x, ids, lows, highs, [held[b] for b in picked], need.astype(bool), k)
                out.append((np.full(len(found[0]), batch.column("batch")[at].as_py(), np.int64), *found))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(
                    zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))], ["batch", "row", "slot", "vec_id", "score"])

    wanted = chosen.select("shard", F.explode("picked").alias("number")).distinct()
    data = table.filter("kind = 0").select("shard", "number", "n", "ids", "x").join(wanted, ["shard", "number"], "left_semi")
    both = (data.select("shard", F.lit(0).alias("kind"), "number", "n", "ids", "x", none.cast("long").alias("batch"),
                        *[none.cast("binary").alias(c) for c in ("lows", "highs", "need")], none.cast("array<int>").alias("picked"))
            .unionByName(asked.join(chosen, "batch").select("shard", F.lit(1).alias("kind"), none.cast("int").alias("number"), "n", "ids", "x", "batch",
                                                            "lows", "highs", "need", "picked")))
    return (both.repartition(last + 1, "shard").sortWithinPartitions("shard", "kind")
            .mapInArrow(read, "batch long, row int, slot int, vec_id long, score long"))


def _best(x: np.ndarray, ids: np.ndarray, lows: np.ndarray, highs: np.ndarray, held: list, need: np.ndarray, k: int) -> tuple:
    """(row, slot, vec_id, score): the ``k`` best of the blocks ``held`` in each window, ties to smaller ids.

    A window's lower end rises to its k-th score as blocks are read, and rows that a block can
    no longer serve leave it out.
    """
    floor = lows.astype(object)
    empty = np.zeros(0, np.int64)
    group, vec, score = empty, empty, np.zeros(0, object)
    slots = lows.shape[1]
    for b, (own, block) in enumerate(held):
        rows = np.flatnonzero(need[:, b])
        if not len(rows):
            continue
        _, most = reach(x[rows], block.min(axis=0, keepdims=True), block.max(axis=0, keepdims=True))
        rows = rows[(most[:, :1] >= floor[rows]).any(axis=1)]
        if not len(rows):
            continue
        s = scores(x[rows], block)
        others = own[None, :] != ids[rows][:, None]
        parts = [(group, vec, score)]
        for slot in range(slots):
            low, high = floor[rows, slot][:, None], highs[rows, slot][:, None]
            hit = others & (s >= low.astype(s.dtype)) & (s <= high.astype(s.dtype))
            at, place = np.nonzero(hit)
            parts.append((rows[at] * slots + slot, own[place], s[at, place].astype(object)))
        group, vec, score = (np.concatenate(c) for c in zip(*parts))
        value = score.astype(float) if s.dtype == float else score
        order = np.lexsort((vec, -value, group)) if s.dtype == float else np.array(
            sorted(range(len(group)), key=lambda i: (group[i], -score[i], vec[i])), np.int64)
        group, vec, score = group[order], vec[order], score[order]
        first = np.searchsorted(group, group, "left")
        rank = np.arange(len(group)) - first
        full = rank == k - 1
        floor[group[full] // slots, group[full] % slots] = score[full]
        kept = rank < k
        group, vec, score = group[kept], vec[kept], score[kept]
    return group // slots, group % slots, vec, score.astype(np.int64)


def mined(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, **layout) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for ``quantised`` rows.

    An anchor (id divisible by ``every``) has as positives its best ``positives`` other rows of its label, and for each
    of them the best ``negatives`` rows of other labels whose score is between ``least`` and ``most`` per cent of
    the positive's. Ties go to the smaller id. Rows that share the anchor's id take no part in its lists; a repeated
    anchor asks once, other repeated rows count as often as they stand there. Shorter vectors go on with zeros. A positive without
    a row in its window, and an anchor without positives, have no rows; an empty table gives none. Pairs whose score is
    beyond 2**62 either way, which a long can hardly hold, take no part.
    """
    made, width = blocks(vectors, positives, every, **layout)
    table = stored(made)
    batches = table.filter("kind = 1").select((F.col("shard").cast("long") * (1 << 31) + F.col("number")).alias("batch"), "label", "n", "ids", "x", "floors")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            highs = [np.full(n, -NONE, "<i8").tobytes() for n in batch.column("n").to_pylist()]
            yield batch.rename_columns([*batch.schema.names[:-1], "lows"]).append_column("highs", pa.array(highs, pa.binary()))

    asked = batches.mapInArrow(ends, "batch long, label long, n int, ids binary, x binary, lows binary, highs binary")
    found = _read(asked, table, width, True, positives)
    order = Window.partitionBy("batch", "row").orderBy(F.desc("score"), "vec_id")
    best = stored(found.withColumn("slot", F.row_number().over(order) - 1).filter(F.col("slot") < positives))

    # At most batch_rows * positives entries for a batch.
    listed = best.groupBy("batch").agg(F.collect_list(F.struct("row", "slot", "score")).alias("best"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, highs = [], []
            for n, found in zip(batch.column("n").to_pylist(), batch.column("best").to_pylist()):
                low, high = np.full((n, positives), (1 << 63) - 1, object), np.full((n, positives), NONE, object)  # empty windows
                for p in found:
                    a, b = _windows(np.array([p["score"]]), least, most)
                    low[p["row"], p["slot"]], high[p["row"], p["slot"]] = a[0], b[0]
                lows.append(low.astype("<i8").tobytes())
                highs.append(high.astype("<i8").tobytes())
            rest = batch.drop_columns(["best"])
            yield rest.append_column("lows", pa.array(lows, pa.binary())).append_column("highs", pa.array(highs, pa.binary()))

    asked = (batches.drop("floors").join(listed, "batch")
             .mapInArrow(windows, "batch long, label long, n int, ids binary, x binary, lows binary, highs binary"))
    below = _read(asked, table, width, False, negatives)
    order = Window.partitionBy("batch", "row", "slot").orderBy(F.desc("score"), "vec_id")
    below = below.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, label, n, ids, x in zip(*(batch.column(c).to_pylist() for c in ("batch", "label", "n", "ids", "x"))):
                yield pa.RecordBatch.from_pydict({
                    "batch": pa.array(np.full(n, number, np.int64)), "row": pa.array(np.arange(n, dtype=np.int32)),
                    "anchor_id": pa.array(np.frombuffer(ids, "<i8").astype(np.int64)), "label": pa.array(np.full(n, label, np.int64)),
                    "x": [v.tobytes() for v in _matrix(x, n, width)]})

    # Copies of an anchor in other shards have asked as well; one of them answers.
    anchors = (batches.mapInArrow(numbered, "batch long, row int, anchor_id long, label long, x binary").groupBy("anchor_id", "label", "x")
               .agg(F.min(F.struct("batch", "row")).alias("first")).select("anchor_id", "first.batch", "first.row"))
    positive = best.select("batch", "row", "slot", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (below.select("batch", "row", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(positive, ["batch", "row", "slot"]).join(anchors, ["batch", "row"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


SQL = """
WITH sound AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, v.vec_id, v.label,
         CAST(list_sum(list_transform(list_zip(a.x, v.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM sound a JOIN sound v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND n.label <> n.anchor_label
 AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
