"""What the training-data operators share: stored tables, Arrow batches as bytes, word hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = (9, 10, 11, 12, 13, 32)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: dict[str, np.ndarray] = {}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder (``spark.checkpoint.dir``) and read it back.

    Cuts the lineage: the files outlive any executor, and every later pass reads
    the same rows. They are deleted when the session ends.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    where = f"{folder.rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(where)
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(where)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Long texts: fewer rows in an Arrow batch than Spark's default, so that a batch stays small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def text_bytes(df: DataFrame, column: str = "text"):
    """The text as bytes; a null text counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit("")).cast("binary")


def text_slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of one slice are at most ``size`` bytes, or one text."""
    for batch in batches:
        lengths = np.diff(offsets_of(batch.column(column)))
        start, held = 0, 0
        for row, n in enumerate(lengths):
            if row > start and held + n > size:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def offsets_of(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    return offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a binary column as one array of bytes, and where each begins (and the last ends)."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = offsets_of(column)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        powers = {}
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(base), np.uint64)
            steps[0] = 1
            powers[name] = np.multiply.accumulate(steps)
        if size > 4 * SLICE:  # for one very long span: not kept
            return powers["up"], powers["down"]
        _POWERS.update(powers)
    return _POWERS["up"], _POWERS["down"]


def guarded(df: DataFrame, *own: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with all columns but ``own`` renamed, so that no name clashes with an operator's; and the new names."""
    names = {c: c if c in own else f"given_{k}" for k, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(new) for c, new in names.items()]), names


def given_back(out: DataFrame, names: dict[str, str], *added: str) -> DataFrame:
    """The columns of ``guarded`` under their old names; ``added`` ones follow and replace those of the same name."""
    old = [F.col(new).alias(c) for c, new in names.items() if c not in added]
    return out.select(*old, *added)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers evenly (the finishing steps of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


SLICE = 1 << 19  # bytes hashed at once; the work arrays are some fifty times as large


def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return sums, down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, the same wherever the span lies.

    Long data are hashed slice by slice, so the memory follows the longest span and not the data.
    """
    out = np.zeros(len(starts), np.uint64)
    if (starts[1:] < starts[:-1]).any():
        order = np.argsort(starts, kind="stable")
        out[order] = span_hashes(data, starts[order], ends[order])
        return out
    at = 0
    while at < len(starts):
        low = int(starts[at])
        upto = max(int(np.searchsorted(starts, low + SLICE, "left")), at + 1)
        first, last = starts[at:upto] - low, ends[at:upto] - low
        sums, down = _prefix_sums(data[low:low + int(last.max())])
        out[at:upto] = mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
        at = upto
    return out


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` bytes from every place on, as ``span_hashes`` gives it."""
    count = max(len(data) - size + 1, 0)
    out = np.zeros(count, np.uint64)
    for low in range(0, count, SLICE):
        n = min(SLICE, count - low)
        sums, down = _prefix_sums(data[low:low + n + size - 1])
        out[low:low + n] = mixed((sums[size:] - sums[:n]) * down[:n] + np.uint64(size))
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run of bytes other than ASCII white space."""
    inside = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # words never go on into the next text
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``words`` lower-cased words, and the text number of each.

    A text of fewer words has one shingle, of all its words; a text without words has none.
    """
    data = lowered(data)
    starts, ends, owner = word_spans(data, offsets)
    single = span_hashes(data, starts, ends)
    n = len(single)
    if not n:
        return single, owner
    texts = len(offsets) - 1
    per_text = np.bincount(owner, minlength=texts)
    first = np.concatenate(([0], np.cumsum(per_text)))[:-1]
    left = (first + per_text)[owner] - np.arange(n)  # words from here to the text's end
    total = np.zeros(n, np.uint64)
    for k in range(min(words, n)):
        part = np.zeros(n, np.uint64)
        part[:n - k] = single[k:]
        total = np.where(left > k, total * np.uint64(_BASE) + part, total)
    keep = (left >= words) | ((per_text < words)[owner] & (left == per_text[owner]))
    return mixed(total[keep]), owner[keep]
