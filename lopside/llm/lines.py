"""Substring dedup by hashing paragraphs, lines, sentences and, on demand, passages that begin and end anywhere.

Each unit is normalised and hashed where its document lies; only digests and
offsets are shuffled. The digest groups, one table for units of all sizes, keep the earliest occurrence in the whole
table by a combining minimum. The few digests that hold more than a thousandth of
all units are joined by a broadcast, so no group of the other join can be larger.

Passages are windows of words. The least hash of the short word runs inside a window is its anchor; equal windows have
equal anchors, and some twenty neighbours share one. Only windows whose anchor stands in several documents are shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lopside.llm.common import (_BASE, _powers, flat_bytes, given_back, guarded, lowered, mixed, small_batches, span_hashes, stored,
                                text_bytes, text_slices, word_spans)

HEAVY_SHARE = 1000
ANCHOR_WORDS = 10


def keyed(docs: DataFrame) -> DataFrame:
    """Rows with ``_key``: rows with the same id and text are one document, others are told apart."""
    return docs.withColumn("_key", F.xxhash64(docs["doc_id"].cast("string"), F.coalesce(docs["text"].cast("string"), F.lit(""))))


_BLANK = re.compile(rb"\n[ \t\r\x0b\x0c]*(?=\n)")
_SENTENCE = re.compile(rb"[.!?][ \t\r\x0b\x0c]+")


def spans_of(text: bytes, sentence_words: int, block_words: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, normal form) of the units of a text that are long enough to be judged.

    Paragraphs end at blank lines, lines at newlines, sentences at a full stop, question or exclamation mark before white space,
    or at the line's end. Sentences count from ``sentence_words`` words on, lines and paragraphs of several ones
    from ``block_words``. A paragraph of one line, and a line of one sentence, are the smaller unit.
    """
    at = 0
    for part in [*(m.end() for m in _BLANK.finditer(text)), len(text)]:
        paragraph = text[at:part]
        words, lines = [], []
        start = at
        for line in paragraph.split(b"\n"):
            cuts = [0, *(m.end() for m in _SENTENCE.finditer(line)), len(line)]
            own, sentences = [], 0
            for a, b in zip(cuts[:-1], cuts[1:]):
                some = line[a:b].lower().split()
                own += some
                if some:
                    sentences += 1
                    if len(some) >= sentence_words:
                        yield start + a, start + b, b" ".join(some)
            if sentences > 1 and len(own) >= block_words:
                yield start, start + len(line), b" ".join(own)
            words += own
            if own:
                lines.append((start, start + len(line)))
            start += len(line) + 1
        if len(lines) > 1 and len(words) >= block_words:
            yield lines[0][0], lines[-1][1], b" ".join(words)
        at = part


class Words:
    """The words of some texts in lower case: their places, texts and hashes."""

    def __init__(self, texts: pa.Array):
        data, offsets = flat_bytes(texts)
        self.data = lowered(data)
        self.starts, self.ends, self.owner = word_spans(self.data, offsets)
        self.single = span_hashes(self.data, self.starts, self.ends)
        self.base = offsets[self.owner]

    def spans(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte offsets in their text of the words ``first`` to ``last``, with the white space up to the next word of the line."""
        end, after = self.ends[last], np.minimum(last + 1, len(self.starts) - 1)
        newlines = np.concatenate(([0], np.cumsum(self.data == 10)))
        joined = (self.owner[after] == self.owner[last]) & (after > last) & (newlines[self.starts[after]] == newlines[end])
        return self.starts[first] - self.base[first], np.where(joined, self.starts[after], end) - self.base[first]

    def stretches(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last word of the places where one word stands ``words`` times or more in a row."""
        n = len(self.single)
        new = np.ones(n, bool)
        new[1:] = (self.single[1:] != self.single[:-1]) | (self.owner[1:] != self.owner[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], n)[:len(first)] - 1
        long = last - first + 1 >= words
        return first[long], last[long]

    def runs(self, words: int, salt: int = 0) -> np.ndarray:
        """The hash of the ``words`` words from each one on, into the next texts as well."""
        n = len(self.single)
        if n < words:
            return np.zeros(0, np.uint64)
        up, down = _powers(n + 1)
        single = mixed(self.single + np.uint64(salt)) if salt else self.single
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(single * up[:n], out=sums[1:])
        return mixed((sums[words:] - sums[:n - words + 1]) * down[:n - words + 1])

    def windows(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and anchor of each window of ``words`` words of one text."""
        size = min(ANCHOR_WORDS, words)
        least, width, wanted = self.runs(size), 1, words - size + 1
        while width < wanted and len(least):
            step = min(width, wanted - width)
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
            width += step
        whole = np.flatnonzero(self.owner[:len(least)] == self.owner[words - 1:words - 1 + len(least)])
        return whole, least[whole]


def units(docs: DataFrame, sentence_words: int, block_words: int, stretch_words: int) -> DataFrame:
    """(doc_id, _key, start, end, digest, across): the units of all documents, by byte offsets in the original text.

    Besides those of ``spans_of``: places where one word stands ``stretch_words`` times or more, equal whatever their length.
    These are ``across``: they are compared with other documents only.
    """
    names = ["doc_id", "_key", "start", "end", "digest", "across"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "_text"):
            out: list[list] = [[] for _ in names]
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                for start, end, normal in spans_of(text, sentence_words, block_words):
                    digest = hashlib.blake2b(normal, digest_size=16).digest()
                    for column, value in zip(out, (doc_id, key, start, end, digest, False)):
                        column.append(value)
            words = Words(batch.column("_text"))
            first, last = words.stretches(stretch_words)
            for row, word, *span in zip(words.owner[first], first, *words.spans(first, last)):
                # A newline before the word: no other unit has one.
                normal = b"\n" + words.data[words.starts[word]:words.ends[word]].tobytes()
                digest = hashlib.blake2b(normal, digest_size=16).digest()
                for column, value in zip(out, (batch.column(0)[row].as_py(), batch.column(1)[row].as_py(), *span, digest, True)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    rows = keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "_key", text_bytes(docs).alias("_text"))
    return rows.mapInArrow(run, "doc_id long, _key long, start long, end long, digest binary, across boolean")


def several(rows: DataFrame, rank: Column) -> DataFrame:
    """The rows of ``rows`` whose digest has several ranks, with the least of them as ``first``."""
    total = rows.count()
    groups = rows.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last"), F.count("*").alias("n"))
    groups = stored(groups.filter("first <> last").drop("last"))
    # At most HEAVY_SHARE digests can each hold more than a HEAVY_SHARE-th of all rows.
    heavy = F.broadcast(groups.filter(F.col("n") * HEAVY_SHARE > total).select("digest", "first"))
    light = groups.filter(F.col("n") * HEAVY_SHARE <= total).select("digest", "first")
    return (rows.join(heavy, "digest")
            .unionByName(rows.join(heavy.select("digest"), "digest", "left_anti").join(light, "digest")))


def repeats(lines: DataFrame) -> DataFrame:
    """The rows of ``lines`` that are not the earliest of their digest, in the order doc_id, key, start, end."""
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key", "start", "end")
    elsewhere = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("_key") == F.col("first._key")))
    return several(lines, rank).filter((rank != F.col("first")) & (~F.col("across") | elsewhere)).drop("first", "across")


def of_same_document(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """``left`` with the columns of ``right`` for the same ``doc_id`` and ``_key``."""
    return (left.withColumnRenamed("doc_id", "_id")
            .join(right.withColumnRenamed("_key", "_of"),
                  F.col("_id").cast("long").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("_of")), how)
            .drop("doc_id", "_of").withColumnRenamed("_id", "doc_id"))


def passages(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, _key, start, end): every window of ``words`` words that an earlier document also holds; ``docs`` with ``_key``.

    Windows compare as units do. Neighbouring equal windows (one word over and over) are one row.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "_key", text_bytes(docs).alias("_text"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "_text"):
            found = Words(batch.column("_text"))
            at, anchor = found.windows(words)
            new = np.ones(len(at), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (found.owner[at[1:]] != found.owner[at[:-1]])
            own = batch.select(["doc_id", "_key"]).take(pa.array(found.owner[at[new]]))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(anchor[new].view(np.int64))], ["doc_id", "_key", "digest"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "_text"):
            found = Words(batch.column("_text"))
            at, anchor = found.windows(words)
            # An anchor of several documents is in the list of each of them.
            wanted = batch.column("_anchors").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            at = at[np.isin(anchor, wanted)]
            one, two = found.runs(words)[at], found.runs(words, _BASE)[at]
            new = np.ones(len(at), bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (at[1:] != at[:-1] + 1) | (found.owner[at[1:]] != found.owner[at[:-1]])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at))[:len(first)] - 1
            start, end = found.spans(at[first], at[last] + words - 1)
            pairs = np.stack([one[first], two[first]], axis=1)
            digests = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(np.arange(len(first) + 1, dtype=np.int32) * 16),
                                                                      pa.py_buffer(np.ascontiguousarray(pairs))])
            own = batch.select(["doc_id", "_key"]).take(pa.array(found.owner[at[first]]))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(start), pa.array(end), digests], ["doc_id", "_key", "start", "end", "digest"])

    shared = several(stored(rows.mapInArrow(anchors, "doc_id long, _key long, digest long")), rank)
    shared = shared.groupBy("doc_id", "_key").agg(F.collect_set("digest").alias("_anchors"))
    rows = of_same_document(rows, shared, "inner").select("doc_id", "_key", "_text", "_anchors")
    found = several(stored(rows.mapInArrow(windows, "doc_id long, _key long, start long, end long, digest binary")), rank)
    return found.filter(rank != F.col("first")).select("doc_id", "_key", "start", "end")


def dedup(docs: DataFrame, sentence_words: int = 15, block_words: int = 40, stretch_words: int = 50, passage_words: int = 0) -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without the units that came earlier elsewhere.

    Added columns (they replace columns of the same name): ``n_units`` (lines of the text), ``removed`` (sorted spans of the
    original text in bytes, apart from one another, each with start and end). Units are those of ``units``; they compare
    in lower case (ASCII) with single spaces. The earliest occurrence is that of the smallest doc_id (null ids last), then the
    earliest start, whatever the size of the unit around it; all others go. With ``passage_words`` every word goes as well that lies in
    a run of so many words that an earlier document holds, wherever it begins and ends. A line of which nothing is left goes with its newline.
    Repeated rows (same id and text) are one document and are
    treated alike. Null and empty texts: nothing removed, null stays null. Empty table: no rows.
    """
    small_batches(docs.sparkSession)
    docs, names = guarded(docs, "doc_id", "text")
    docs = keyed(docs)
    spans = repeats(stored(units(docs, sentence_words, block_words, stretch_words))).select("doc_id", "_key", "start", "end")
    if passage_words:
        spans = spans.unionByName(passages(docs, passage_words))
    spans = (spans.distinct().groupBy("doc_id", "_key")
             .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed")))
    joined = of_same_document(docs, spans, "left").drop("_key")
    return given_back(cut(joined), names, "n_units", "removed")


def joined_spans(text: bytes, spans: list[dict]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one; a line that is wholly covered loses its newline as well."""
    out: list[list[int]] = []
    for span in spans:
        if out and span["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], span["end"])
        else:
            out.append([span["start"], span["end"]])
    whole: list[tuple[int, int]] = []
    for start, end in out:
        if text[end:end + 1] == b"\n" and (start == 0 or text[start - 1:start] == b"\n"):
            end += 1
        if whole and whole[-1][1] == start:
            start = whole.pop()[0]
        whole.append((start, end))
    return whole


def cut(docs: DataFrame) -> DataFrame:
    """Take the spans in ``removed`` out of ``text``."""
    order = [c for c in docs.columns if c not in ("removed", "n_units")]
    names = [c for c in order if c != "text"]
    rows = docs.select(*names, F.col("text").isNull().alias("_none"), text_bytes(docs).alias("_text"),
                       F.coalesce("removed", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("removed"))
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "_text"):
            texts, lines, removed = [], [], []
            for none, text, spans in zip(*(batch.column(c).to_pylist() for c in ("_none", "_text", "removed"))):
                spans = joined_spans(text, spans)
                parts, at = [], 0
                for start, end in spans:
                    parts.append(text[at:start])
                    at = end
                kept = b"".join([*parts, text[at:]])
                if spans and spans[-1][1] == len(text) and not text.endswith(b"\n"):
                    kept = kept.removesuffix(b"\n")  # the newline before a last line that went
                texts.append(None if none else kept.decode("utf-8", "replace"))
                lines.append(text.count(b"\n") + 1 if text else 0)
                removed.append([{"start": a, "end": b} for a, b in spans])
            columns = {n: batch.column(n) for n in names} | {"text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays([*(columns[n] for n in order), pa.array(lines, pa.int32()), pa.array(removed, pairs)],
                                             names=[*order, "n_units", "removed"])

    fields = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in order)
    return rows.mapInArrow(run, f"{fields}, n_units int, removed array<struct<start:bigint,end:bigint>>")


def digest_rows(kept: DataFrame) -> DataFrame:
    """The operator's rows in short."""
    return kept.select("doc_id", "n_units", F.size("removed").alias("n_removed"),
                       F.coalesce(F.expr("aggregate(removed, 0L, (a, s) -> a + s.end - s.start)"), F.lit(0)).alias("removed_bytes"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def changed_length(kind) -> Column:
    """``n_chars`` of the text as it is now, where lines were removed; the given value elsewhere."""
    return F.when(F.size("removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
