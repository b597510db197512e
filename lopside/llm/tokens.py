"""Token ids as files: encoded in ascending doc_id order, packed by Re-Pair, read back at random.

The documents are dealt out by ranges of doc_id, so every task writes one shard: a run
of documents that follow one another. A shard is a run of segments, a segment a row of
whole documents with its place in the shard, the lengths of its documents, and its ids
in blocks (``repair``). The rows are written as Parquet, so that lost tasks are done again
and a reader of lengths alone does not touch the ids.
"""

from __future__ import annotations

import codecs
import gc
import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lopside.llm import repair
from lopside.llm.common import flat_bytes, small_batches, text_bytes, text_slices

SEGMENTS = ("shard int, segment int, first long, n_ids long, doc_id array<long>, doc_tokens array<long>, "
            "blocks array<binary>")
BLOCK = 1 << 18
_KIND = np.zeros(256, np.uint8)  # 1 letter, 2 digit, 3 white space, 4 other ASCII signs; 0: never cut beside it
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_KIND[[b for b in b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"]] = 4
# Letters whose lower case is one letter of the same range; all of them are in composed form.
_LATIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00de\u00e0-\u00f6\u00f8-\u00fe]+$"
# How byte-level vocabularies show bytes: those that print as themselves, the others from 256 on (a fixed value).
_PRINTS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: b for b in _PRINTS} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTS)}
_SHOWN_BYTES = "".join(chr(_SHOWN[b]) for b in range(256))
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_FOLDED[9:14] = 32
_CUT = np.zeros(256, np.uint8)  # by 8 * kind of the byte before + kind of the byte after: whether a token always ends there
for _a in range(5):
    for _b in range(5):
        _k = (_a, _b)
        _CUT[8 * _a + _b] = _b == 3 or (2 in _k and 0 not in _k and 3 not in _k) or _k in ((1, 4), (4, 1))


def _mapped(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[data]`` for bytes."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), np.uint8)


def _cuts(data: np.ndarray) -> np.ndarray:
    """For all bytes but the last whether a token always ends there."""
    kind = _mapped(data, _KIND)
    return _mapped((kind[:-1] << 3) | kind[1:], _CUT).view(bool)


def _strings(column: pa.Array) -> tuple[bytes, list[int]]:
    """The bytes of a large binary or string column without nulls, and where its values begin and end in them."""
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    low, high = int(places[0]), int(places[-1])
    return bytes(memoryview(data)[low:high]) if high > low else b"", (places - low).tolist()


class PieceEncoder:
    """Ids of many texts; each different piece of text is encoded once.

    For vocabularies whose words never reach over white space, ASCII digits, or a change between
    ASCII letters and signs. Apostrophes, the signs of special tokens and everything
    beyond ASCII are never cut from what stands beside them. The pieces are told apart by their bytes.
    Where the file says that words are lower-cased, split and shown byte by byte, words of Latin letters go to
    its model without these steps, which leave them as they are but for their case.
    """

    def __init__(self, path: str, limit: int = 1_000_000, longest: int = 64):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        steps = json.loads(self.tokenizer.to_str())
        kinds = [[x["type"] for x in (steps[k] or {}).get(part, ())]
                 for k, part in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        self.plain = kinds == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]]
        self.special = [x["content"].encode() for x in steps.get("added_tokens", ())]
        self.plain = self.plain and all(len(x) > 1 and not x[:2].isalnum() for x in self.special)
        self.limit, self.longest = limit, longest
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.at, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    @staticmethod
    def _stands_in(data: np.ndarray, string: bytes) -> bool:
        """Whether a special token's string, in any case, may stand in the data: its first two bytes do."""
        a, b = np.frombuffer(string[:2], np.uint8)
        return bool(((data[:-1] == a) & (data[1:] == b)).any())

    def _encode(self, pieces: pa.Array) -> list[list[int]]:
        try:
            texts = pieces.cast(pa.large_string())
        except pa.ArrowInvalid:
            texts = pa.array([x.decode("utf-8", "replace") for x in pieces.to_pylist()], pa.large_string())
        words = pc.utf8_trim(texts, " \t\n\r\v\f")
        latin = pc.match_substring_regex(words, _LATIN).to_numpy(zero_copy_only=False) & self.plain
        out = np.empty(len(pieces), object)
        model = self.tokenizer.model.tokenize
        gc.disable()  # many small lists and no cycles
        raw, ends = _strings(pc.utf8_lower(words.filter(pa.array(latin))))
        shown = codecs.charmap_decode(raw, "strict", _SHOWN_BYTES)[0]  # a character for each byte
        for k, a, b in zip(np.flatnonzero(latin).tolist(), ends, ends[1:]):
            out[k] = [x.id for x in model(shown[a:b])]
        gc.enable()
        rest = texts.filter(pa.array(~latin)).to_pylist()
        for k, e in zip(np.flatnonzero(~latin).tolist(), self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            out[k] = e.ids
        return out.tolist()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and how many each text has."""
        texts = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(texts, np.int64)
        begins = np.zeros(len(data) + 1, bool)
        begins[1:-1] = _cuts(data)
        begins[offsets] = True
        starts = np.flatnonzero(begins)  # the last one is the end
        if self.plain and not any(self._stands_in(data, x) for x in self.special):
            data = _mapped(data, _FOLDED)  # letters and white space that the tokenizer does not tell apart
        column = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)])
        coded = column.dictionary_encode()
        raw, ends = _strings(coded.dictionary)
        pieces = [raw[a:b] for a, b in zip(ends, ends[1:])]
        if len(self.known) > self.limit:
            self.clear()
        number = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(number < 0)
        found = self._encode(coded.dictionary.take(pa.array(new)))
        size = np.array([len(x) for x in found], np.int64)
        # Long pieces, which hardly come twice, stand last and are not kept after this call.
        long = np.array([len(pieces[k]) > self.longest for k in new], bool)
        keep, order = int((~long).sum()), np.argsort(long, kind="stable")
        if keep < len(new):
            found = [found[k] for k in order]
        new, size = new[order], size[order]
        number[new] = len(self.size) + np.arange(len(new))
        ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))))
        at = np.concatenate((self.at, len(self.ids) + np.cumsum(size) - size))
        sizes = np.concatenate((self.size, size))
        which = number[coded.indices.to_numpy()]
        count = sizes[which]
        ends = np.cumsum(count)
        out = ids[np.repeat(at[which] - (ends - count), count) + np.arange(ends[-1])]
        before = np.concatenate(([0], ends))[np.searchsorted(starts, offsets)]
        held = len(self.size) + keep
        self.known.update(zip((pieces[k] for k in new[:keep].tolist()), range(len(self.size), held)))
        self.at, self.size = at[:held], sizes[:held]
        self.ids = ids[:len(self.ids) + int(size[:keep].sum())]
        return out, np.diff(before)


_ENCODERS: dict[str, PieceEncoder] = {}  # a worker's tasks share what is known of a vocabulary, up to its limit


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _segment(shard: int, number: int, first: int, doc_ids: list, counts: np.ndarray, ids: np.ndarray, block: int) -> dict:
    """One row: documents as they follow one another, their ids in blocks of at most twice ``block``."""
    ends = np.cumsum(counts)
    blocks = []
    for part in np.array_split(np.arange(len(ids)), max(1, -(-len(ids) // (2 * block)))):
        a, b = int(part[0]), int(part[-1]) + 1
        starts = np.unique(np.concatenate(([a], (ends - counts)[(ends - counts > a) & (ends - counts < b)]))) - a
        blocks.append(repair.to_bytes(repair.compress(ids[a:b], starts)))
    return {"shard": [shard], "segment": [number], "first": [first], "n_ids": [len(ids)], "doc_id": [doc_ids],
            "doc_tokens": [counts.tolist()], "blocks": [blocks]}


def encoded(docs: DataFrame, tokenizer: str, end_id: int = 2, block: int = BLOCK) -> DataFrame:
    """The segments of ``docs`` (doc_id, text), as ``SEGMENTS`` lists their columns.

    ``tokenizer`` is the path of a ``tokenizers`` file that every task can read. Ids are those of
    ``encode(text, add_special_tokens=False)``, then ``end_id``. Shards rise with doc_id, and so do segments in a
    shard and documents in a segment; null ids come first, equal ids in the order of a hash of
    their texts. Null and empty texts: the end id alone. Repeated rows: each a document. A text of any
    length is one document in one segment of many blocks. Empty table: no rows. Other columns are ignored.
    """
    small_batches(docs.sparkSession, 2000)
    schema = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                        ("doc_id", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("blocks", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(tokenizer), TaskContext.get().partitionId()
        number, first, held = 0, 0, 0
        doc_ids, counts, ids = [], [], []
        for batch in text_slices(batches, "_text", 6 << 20):
            flat, sizes = encode(*flat_bytes(batch.column("_text")))
            flat = np.insert(flat, np.cumsum(sizes), np.uint32(end_id))
            doc_ids += batch.column("doc_id").to_pylist()
            counts.append(sizes + 1)
            ids.append(flat)
            held += len(flat)
            if held >= block:
                yield pa.RecordBatch.from_pydict(
                    _segment(shard, number, first, doc_ids, np.concatenate(counts), np.concatenate(ids), block), schema)
                number, first, held = number + 1, first + held, 0
                doc_ids, counts, ids = [], [], []
        if held:
            yield pa.RecordBatch.from_pydict(
                _segment(shard, number, first, doc_ids, np.concatenate(counts), np.concatenate(ids), block), schema)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_bytes(docs).alias("_text"))
    rows = rows.withColumn("_tie", F.xxhash64("_text"))
    # Equal ids and texts in many rows are dealt out by their place in the input, so that they fill more than one task.
    rows = rows.withColumn("_place", F.monotonically_increasing_id())
    order = ["doc_id", "_tie", "_place"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "_text").mapInArrow(run, SEGMENTS)


def shard_starts(segments: DataFrame) -> DataFrame:
    """(shard, before): the ids in all earlier shards; one row for each file, from the segments' counts alone."""
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    return totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))


def decoded(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the written blocks.

    ``start`` counts the ids of all documents before it; the checksum is of the ids as
    little-endian unsigned 32-bit integers. One block is expanded at a time.
    """
    small_batches(segments.sparkSession, 16)
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard, first, doc_ids, counts = (batch.column(c)[k].as_py() for c in ("shard", "first", "doc_id", "doc_tokens"))
                counts = np.array(counts, np.int64)
                sums = []
                doc, left, crc = 0, int(counts[0]), 0
                for block in batch.column("blocks")[k]:
                    grammar, lengths = repair.from_bytes(block.as_py())
                    raw = memoryview(repair.expand(grammar, lengths, grammar.symbols).astype("<u4").tobytes())
                    at, n = 0, len(raw) // 4
                    while at < n:
                        some = min(left, n - at)
                        crc = zlib.crc32(raw[4 * at:4 * (at + some)], crc)
                        at, left = at + some, left - some
                        if not left:
                            sums.append(crc)
                            doc, crc = doc + 1, 0
                            left = int(counts[doc]) if doc < len(counts) else 0
                if len(sums) != len(counts):
                    raise ValueError("a segment's blocks do not hold the ids that its lengths say")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(counts), shard, np.int32)), pa.array(doc_ids, pa.int64()),
                     pa.array(first + np.cumsum(counts) - counts), pa.array(counts), pa.array(sums, pa.int64())], schema=schema)

    rows = segments.select("shard", "first", "doc_id", "doc_tokens", "blocks").mapInArrow(
        run, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return (rows.join(shard_starts(segments), "shard")
            .select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def stretches(segments: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, start, length, ids) for each row (doc_id, start, length) of ``wanted``: that stretch of a document's ids.

    Only segments that hold a wanted document are read, and in them only the symbols
    of the stretch are expanded. A stretch that reaches beyond its document ends with it; unknown ids give no row;
    an id that stands for several documents gives a row for each.
    """
    index = segments.select("shard", "segment", F.posexplode("doc_id").alias("place", "doc_id"))
    asked = (wanted.select(wanted["doc_id"].cast("long").alias("doc_id"), wanted["start"].cast("long").alias("start"),
                           wanted["length"].cast("long").alias("length")).join(index, "doc_id"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                doc, start, length, place, counts, blocks = (batch.column(c)[k] for c in ("doc_id", "start", "length", "place", "doc_tokens", "blocks"))
                counts, place = np.array(counts.as_py(), np.int64), place.as_py()
                ends = np.cumsum(counts)
                a = int(ends[place] - counts[place]) + max(0, start.as_py())
                b = min(a + max(0, length.as_py()), int(ends[place]))
                out, at = [], 0
                for block in np.array_split(np.arange(int(ends[-1])), len(blocks)):  # the blocks' places follow from the counts
                    low, high = int(block[0]), int(block[-1]) + 1
                    if a < high and b > low:
                        grammar, lengths = repair.from_bytes(blocks[at].as_py())
                        begin = max(low, int(ends[place] - counts[place]))
                        starts = np.concatenate(([0], np.cumsum(lengths[grammar.symbols])))[grammar.first]
                        piece = int(np.searchsorted(starts, begin - low))
                        out += repair.stretch(grammar, lengths, piece, max(a, low) - begin, min(b, high) - max(a, low)).tolist()
                    at += 1
                yield pa.RecordBatch.from_pydict({"doc_id": [doc.as_py()], "start": [start.as_py()], "length": [length.as_py()], "ids": [out]}, schema)

    held = asked.join(segments.select("shard", "segment", "doc_tokens", "blocks"), ["shard", "segment"])
    return held.mapInArrow(run, "doc_id long, start long, length long, ids array<bigint>")


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2) -> None:
    """Write the ids of ``docs`` to ``folder``; ``spark.read.parquet(folder)`` gives the segments back."""
    encoded(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(folder)
