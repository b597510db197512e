"""Substring dedup: every byte of a 100-byte string that also starts earlier goes.

Each 100-byte string has an anchor, the byte run inside it with the least hash, which
is the same wherever the string stands. Strings whose anchor occurs once in the corpus
cannot repeat; the others are sent, as segments of neighbouring strings with one
anchor, to the shard of that anchor. A shard sorts the suffixes of its segments by
induced sorting, compares neighbours byte by byte, and keeps the earliest of equal
strings. Segments that repeat within a slice of the input are settled there, so a passage
that many documents share reaches its shard a few times only. Segments and spans travel
as compressed payloads, one for each slice and shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lopside.llm.common import flat_bytes, gram_hashes, mixed, small_batches, span_hashes, text_bytes, text_slices
from lopside.llm.decontaminate import row_key
from lopside.llm.suffixes import permuted_prefixes, suffix_array

LENGTH, GRAM = 100, 24
LEAST_PARTS, MOST_PARTS, PART_ANCHORS = 256, 1 << 14, 1 << 20
MOST_BITS = 1 << 30
NONE_LAST = np.iinfo(np.int64).max
PARTED = "part long, kind int, payload binary"


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """Runs of neighbouring windows with one anchor: first start, last start, anchor hash, text."""
    n, wide = len(data), length - GRAM + 1
    starts = np.arange(max(n - GRAM + 1, 0))
    if n < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    grams = gram_hashes(data, GRAM)
    # Order by hash, ties by place: the upper 32 bits, and the place in the lower 32.
    key = (grams & ~np.uint64((1 << 32) - 1)) | starts.astype(np.uint64)
    blocks = -(-len(key) // wide)
    filled = np.full(blocks * wide, np.iinfo(np.uint64).max, np.uint64)
    filled[:len(key)] = key
    square = filled.reshape(blocks, wide)
    ahead = np.minimum.accumulate(square, axis=1).reshape(-1)
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = n - length + 1
    anchor = (np.minimum(behind[:windows], ahead[wide - 1:wide - 1 + windows]) & np.uint64((1 << 32) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    whole = np.arange(windows) + length <= offsets[text + 1]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])) | ~whole | np.append(False, ~whole[:-1])
    first = np.flatnonzero(new & whole)
    cut = np.append(np.flatnonzero(new), windows)
    last = cut[np.searchsorted(cut, first, "right")] - 1
    return first, last, grams[anchor[first]], text[first]


def part_count(n_bytes: int) -> int:
    """A power of two: parts of about PART_ANCHORS anchors, of which there are two in as many bytes as a window has places."""
    anchors = 2 * n_bytes // (LENGTH - GRAM + 2)
    return min(MOST_PARTS, max(LEAST_PARTS, 1 << (anchors // PART_ANCHORS).bit_length()))


def _part(spread: np.ndarray, parts: int) -> np.ndarray:
    return (spread >> np.uint64(65 - parts.bit_length())).astype(np.int64)


def repeated_anchors(rows: DataFrame, parts: int = LEAST_PARTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A filter of the anchors that occur more than once: 64-bit words, and each part's first word and number of bits.

    Anchors are least hashes, so they are spread anew before they are dealt out. A part has sixteen
    bits or more for each of its repeated anchors, as far as MOST_BITS go for all parts.
    """
    most = MOST_BITS // parts

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "_text", 8 << 20):
            spread = np.sort(mixed(segments(*flat_bytes(batch.column("_text")))[2]))
            cut = np.searchsorted(_part(spread, parts), np.arange(parts + 1))
            some = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([spread[cut[k]:cut[k + 1]].tobytes() for k in some], pa.binary())],
                                             names=["part", "anchors"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for part, anchors in zip(batch.column("part").to_pylist(), batch.column("anchors").to_pylist()):
                seen.setdefault(part, []).append(np.frombuffer(anchors, np.uint64))
        for part, lists in seen.items():
            values = np.sort(np.concatenate(lists))
            twice = np.unique(values[1:][values[1:] == values[:-1]])
            own = min(most, max(64, 1 << (16 * len(twice) - 1).bit_length())) if len(twice) else 64
            words = np.zeros(own // 64, np.uint64)
            for slot in _slots(twice, np.uint64(own)):
                np.bitwise_or.at(words, slot >> np.uint64(6), np.uint64(1) << (slot & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([words.tobytes()], pa.binary())], names=["part", "bits"])

    found = (rows.select("_text").mapInArrow(emit, "part int, anchors binary").repartition("part")
             .mapInArrow(gather, "part int, bits binary").collect())  # a row for each part, MOST_BITS in all
    stretches = [np.zeros(1, np.uint64)] * parts
    for row in found:
        stretches[row["part"]] = np.frombuffer(row["bits"], np.uint64)
    size = np.array([len(x) for x in stretches], np.int64)
    return np.concatenate(stretches), np.cumsum(size) - size, (64 * size).astype(np.uint64)


def _slots(spread: np.ndarray, own: np.ndarray | np.uint64) -> list[np.ndarray]:
    step = mixed(spread) | np.uint64(1)
    return [(spread + np.uint64(k) * step) & (own - np.uint64(1)) for k in range(4)]


def _may_repeat(anchor: np.ndarray, filters: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    words, first, own = filters
    spread = mixed(anchor)
    ok, part = np.ones(len(spread), bool), _part(spread, len(own))
    for slot in _slots(spread, own[part]):
        ok &= (words[first[part] + (slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
    return ok


def identity(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128 bits that stand for the bytes of each span."""
    other = (data * np.uint8(167) + np.uint8(13)) ^ np.uint8(0x5A)
    return np.stack((span_hashes(data, starts, ends), span_hashes(other, starts, ends)), axis=1)


def firsts(same: np.ndarray, ids: np.ndarray, keys: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows with one identity: which comes first (by id, key, start), and which repeat it.

    A row in the first one's own place (a document given twice) is neither.
    """
    order = np.lexsort((start, keys, ids, same[:, 1], same[:, 0]))
    new = np.append(True, (same[order][1:] != same[order][:-1]).any(axis=1)) if len(order) else np.zeros(0, bool)
    lead = np.empty(len(order), np.int64)
    lead[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    early = lead == np.arange(len(order))
    twin = (ids == ids[lead]) & (keys == keys[lead]) & (start == start[lead])
    return early, ~twin


def _packed(*arrays: np.ndarray) -> bytes:
    raw = b"".join([np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes(), *(a.tobytes() for a in arrays)])
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(payload: bytes, *kinds) -> list[np.ndarray]:
    size = int(np.frombuffer(payload, np.int64, 1)[0])
    raw = pa.decompress(payload[8:], size, codec="zstd", asbytes=True)
    sizes = np.frombuffer(raw, np.int64, len(kinds) + 1)[1:]
    ends = 8 * (len(kinds) + 1) + np.cumsum(sizes)
    return [np.frombuffer(raw[e - n:e], kind) for e, n, kind in zip(ends.tolist(), sizes.tolist(), kinds)]


def _blobs(part: np.ndarray, arrays: list[np.ndarray], texts: tuple | None = None) -> Iterator[tuple[int, bytes]]:
    """Rows dealt out to parts: one packed payload for each part that has rows."""
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.append(True, np.diff(part[order]) != 0)) if len(order) else np.zeros(0, np.int64)
    for a, b in zip(cut, np.append(cut[1:], len(order))):
        rows = order[a:b]
        extra = ()
        if texts is not None:
            data, first, last = texts
            extra = (data[_places(first[rows], last[rows])],)
        yield int(part[rows[0]]), _packed(*(x[rows] for x in arrays), *extra)


def _places(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges from ``first`` to ``end``, on end."""
    size = end - first
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _joined(first: np.ndarray, end: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of one owner that touch or overlap, made one."""
    order = np.lexsort((first, owner))
    first, end, owner = first[order], end[order], owner[order]
    if not len(first):
        return first, end, owner
    shift = owner * np.int64(1 << 40)  # owners far apart, so one running maximum serves all
    reach = np.maximum.accumulate(end + shift)
    new = np.append(True, first[1:] + shift[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return first[at], reach[np.append(at[1:], len(new)) - 1] - shift[at], owner[at]


def candidates(rows: DataFrame, filters: tuple[np.ndarray, np.ndarray, np.ndarray], parts: int) -> DataFrame:
    """(part, kind, payload): segments that may repeat, by anchor (kind 0), and repeated spans by document (kind 1).

    Of equal segments in one slice of the input only the earliest goes on; the others are spans already.
    """
    shared = rows.sparkSession.sparkContext.broadcast(filters)  # at most MOST_BITS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        for batch in text_slices(batches, "_text", 8 << 20):
            data, offsets = flat_bytes(batch.column("_text"))
            first, last, anchor, text = segments(data, offsets)
            keep = _may_repeat(anchor, filters)
            first, end, anchor, text = first[keep], last[keep] + LENGTH, anchor[keep], text[keep]
            if not len(first):
                continue
            ids, keys = _ids(batch.column("doc_id")), batch.column("_key").to_numpy()
            start = first - offsets[text]
            early, again = firsts(identity(data, first, end), ids[text], keys[text], start)
            a, b, owner = _joined(start[again], (end - first + start)[again], text[again])
            out = [(1, *blob) for blob in _blobs(keys[owner] % parts, [ids[owner], keys[owner], a, b])]
            k = np.flatnonzero(early)
            part = (mixed(anchor[k]) % np.uint64(parts)).astype(np.int64)
            out += [(0, *blob) for blob in _blobs(part, [ids[text[k]], keys[text[k]], start[k], (end - first)[k], anchor[k]],
                                                  (data, first[k], end[k]))]
            yield _batch(out)

    return rows.mapInArrow(run, PARTED)


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
                                       pa.array([r[2] for r in rows], pa.binary())], names=["part", "kind", "payload"])


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NONE_LAST).to_numpy()


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "payload"))))
    for part, group in groupby(rows, key=lambda row: row[0]):
        yield part, [(kind, payload) for _, kind, payload in group]


def shard_repeats(ids: np.ndarray, keys: np.ndarray, starts: np.ndarray, size: np.ndarray, data: np.ndarray):
    """Windows that start earlier elsewhere: segment number, and first and last window of each run in it."""
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    window = np.arange(len(data)) - begin[owner]
    valid = window + LENGTH <= size[owner]
    order = suffix_array(data, LENGTH)
    order = order[valid[order]]
    group = np.cumsum(permuted_prefixes(data, order, LENGTH) < LENGTH)
    alone = np.append(True, np.diff(group) != 0) & np.append(np.diff(group) != 0, True)
    order, group = order[~alone], group[~alone]
    segment = owner[order]
    ranked = np.lexsort((starts[segment] + window[order], keys[segment], ids[segment], group))
    later = np.append(False, group[ranked][1:] == group[ranked][:-1]) if len(ranked) else np.zeros(0, bool)
    gone = np.zeros(len(data) + 1, bool)
    gone[order[ranked[later]]] = True
    edge = np.diff(np.concatenate(([0], gone.astype(np.int8))))
    first, last = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0) - 1
    return owner[first], window[first], window[last]


def shard_spans(table: DataFrame, parts: int, at_once: int = 1 << 20) -> DataFrame:
    """Repeated spans as payloads by document (kind 1): those at hand, and those of the segments (kind 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_part(batches):
            settled = [(1, part, payload) for kind, payload in rows if kind == 1]
            if settled:
                yield _batch(settled)
            got = [_unpacked(p, np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint8) for kind, p in rows if kind == 0]
            if not got:
                continue
            ids, keys, start, size, anchor, data = (np.concatenate(c) for c in zip(*got))
            begin = np.cumsum(size) - size
            early, again = firsts(identity(data, begin, begin + size), ids, keys, start)
            found = [(np.flatnonzero(again), np.zeros(again.sum(), np.int64), (size - LENGTH)[again])]
            k = np.flatnonzero(early)
            k = k[np.argsort(anchor[k], kind="stable")]
            # Equal strings have their anchor in the same place, so a segment repeats nothing of itself.
            _, several = np.unique(anchor[k], return_counts=True)
            k = k[np.repeat(several > 1, several)]
            whole = np.flatnonzero(np.append(len(k) > 0, anchor[k][1:] != anchor[k][:-1]))  # anchors stay together
            filled = (np.cumsum(size[k]) - size[k])[whole]
            cut = np.append(whole[np.flatnonzero(np.append(len(k) > 0, np.diff(filled // at_once) > 0))], len(k))
            for a, b in zip(cut[:-1], cut[1:]):
                rows_here = k[a:b]
                pieces = data[_places(begin[rows_here], (begin + size)[rows_here])]
                segment, low, high = shard_repeats(ids[rows_here], keys[rows_here], start[rows_here], size[rows_here], pieces)
                found.append((rows_here[segment], low, high))
            at, low, high = (np.concatenate(c) for c in zip(*found))
            out = _blobs(keys[at] % parts, [ids[at], keys[at], start[at] + low, start[at] + high + LENGTH])
            if len(at):
                yield _batch([(1, *blob) for blob in out])

    return table.repartition("part").sortWithinPartitions("part").mapInArrow(run, PARTED)


def dedup(docs: DataFrame, docs_per_part: int = 1000) -> DataFrame:
    """All columns of ``docs`` with ``n_bytes``, ``removed`` and ``kept``.

    ``removed``: maximal runs (start, end) of bytes covered by a 100-byte string of the table that also
    starts earlier: in a document of smaller doc_id (null ids last, equal ids by a hash of the text), or
    earlier in the same one. ``kept``: the other bytes, joined. Strings are judged on the input and never
    cross documents. Rows with the same id and text are one document and treated alike. Null texts are
    empty; an empty table gives no rows; columns of the added names are replaced.
    """
    small_batches(docs.sparkSession)
    docs = row_key(docs.drop("n_bytes", "removed", "kept"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "_key", text_bytes(docs).alias("_text"))
    count, n_bytes = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()
    parts = max(64, count // docs_per_part)
    spans = shard_spans(candidates(rows, repeated_anchors(rows, part_count(n_bytes)), parts), parts)
    names = [c for c in docs.columns if c != "_key"]
    given = docs.select(F.pmod("_key", F.lit(parts)).alias("part"), F.lit(2).alias("kind"), F.lit(None).cast("binary").alias("payload"),
                        docs["doc_id"].cast("long").alias("_id"), "_key", F.struct(*names).alias("_row"))
    both = given.unionByName(spans, allowMissingColumns=True).repartition("part").sortWithinPartitions("part", "kind")
    fields = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    return both.mapInArrow(_cut(names), f"{fields}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")


def _cut(names: list[str]):
    """Documents without their spans; a part's span payloads (kind 1) come before its documents (kind 2)."""
    def spans_of(payloads: list[bytes]) -> dict:
        if not payloads:
            return {}
        got = [_unpacked(p, *[np.int64] * 4) for p in payloads]
        ids, keys, first, end = (np.concatenate(c) for c in zip(*got))
        docs, owner = np.unique(np.stack((ids, keys), axis=1), axis=0, return_inverse=True)
        first, end, owner = _joined(first, end, owner.reshape(-1))
        cut = np.searchsorted(owner, np.arange(len(docs) + 1)).tolist()
        runs = list(zip(first.tolist(), end.tolist()))
        return {tuple(doc): runs[a:b] for doc, a, b in zip(docs.tolist(), cut[:-1], cut[1:])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, payloads, spans = None, [], None
        pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            size, removed, kept, at = [], [], [], []
            texts = batch.column("_row").field("text").cast(pa.string()).cast(pa.binary()).to_pylist()
            for k, (own, kind, payload, doc_id, key) in enumerate(zip(
                    *(batch.column(c).to_pylist() for c in ("part", "kind", "payload", "_id", "_key")))):
                if own != part:
                    part, payloads, spans = own, [], None
                if kind == 1:
                    payloads.append(payload)
                    continue
                if spans is None:
                    spans, payloads = spans_of(payloads), []
                text = texts[k] or b""
                runs, parts, done = spans.get((NONE_LAST if doc_id is None else doc_id, key), ()), [], 0
                for a, b in runs:
                    parts.append(text[done:a])
                    done = b
                at.append(k)
                size.append(len(text))
                removed.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join([*parts, text[done:]]))
            if at:
                rows = batch.column("_row").take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*(rows.field(n) for n in names), pa.array(size, pa.int64()), pa.array(removed, pair),
                                                  pa.array(kept, pa.binary())], names=[*names, "n_bytes", "removed", "kept"])

    return run


def digest_rows(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_bytes", F.expr("aggregate(removed, 0L, (a, s) -> a + s.end - s.start)").alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
