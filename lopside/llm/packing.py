"""Order-preserving packing: window cuts at document or sentence ends, by dynamic programming.

Each input partition packs its own documents in their order, so nothing is
shuffled. Over a stretch of tokens the cuts are those of least total cost, where
a window costs its padding plus a penalty for the place where it ends: none at a
document's end, a little at a sentence's end, more inside a sentence. The best
predecessor of a cut is the least value in a sliding range, which a monotone
queue gives in constant time.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lopside.llm.common import flat_bytes, small_batches, span_hashes, text_bytes, text_slices

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
# Bytes that can stand after a cut, and last bytes that can stand before one, without any
# look at the rest: ASCII, and letters of two bytes. Elsewhere no cut is made, which is always right.
_OPENS = ~_SPACE & ~np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3]) & ~((np.arange(256) >= 0x80) & (np.arange(256) < 0xC0))
_ASCII = ~_SPACE & (np.arange(256) < 0x80)
_STOPS = np.isin(np.arange(256), list(b".!?\n"))


def byte_bpe(path: str):
    """A fast encoder with the vocabulary of a byte-level BPE file of the ``tokenizers`` library."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {x["content"]: x["id"] for x in model.get("added_tokens", ())}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    ranks = {bytes(byte_of[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in special}
    # The usual pre-tokenising pattern of byte-level BPE (a fixed value).
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


class CachedEncoder:
    """Token ids of many texts at once; each different stretch between spaces is encoded once.

    Texts are cut before single spaces and around single newlines, where a byte-level BPE
    always begins a new word. Stretches are found again by a 64-bit hash. The strings of special tokens
    (which hold no white space) stand for these tokens, as the ``tokenizers`` library has it by default.
    """

    def __init__(self, encoding, limit: int = 1_000_000):
        self.encode, self.special, self.limit = encoding.encode_ordinary, encoding.special_tokens_set, limit
        self.with_special = lambda text: encoding.encode(text, allowed_special="all")
        self.newline = self.encode("\n")[0]
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, spans: list[bytes]) -> None:
        """Encode new stretches: those without newlines or white space at their ends, but for one space before, in one go, one a line."""
        texts = [x.decode("utf-8", "replace") for x in spans]
        # Other white space after the joining newline would make one token with it.
        special = [any(s in x for s in self.special) for x in texts]
        plain = np.array([x != "" and "\n" not in x and not x[-1].isspace() and not x.removeprefix(" ")[0].isspace() and not own
                          for x, own in zip(texts, special)], bool)
        joined = np.array(self.encode("\n".join([x for x, k in zip(texts, plain.tolist()) if k])), np.uint32)
        line_ends = np.append(np.flatnonzero(joined == self.newline), len(joined))
        line_starts = np.concatenate(([0], line_ends[:-1] + 1))
        at, size, grown = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), [self.ids, joined]
        if plain.any():
            at[plain], size[plain] = len(self.ids) + line_starts, line_ends - line_starts
        held = len(self.ids) + len(joined)
        for k in np.flatnonzero(~plain):
            grown.append(np.array((self.with_special if special[k] else self.encode)(texts[k]), np.uint32))
            at[k], size[k] = held, len(grown[-1])
            held += len(grown[-1])
        self.ids = np.concatenate(grown)
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at = np.insert(self.at, where, at)
        self.size = np.insert(self.size, where, size)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts on end, tokens per text, and the token positions after sentence ends."""
        texts = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(texts, np.int64), np.zeros(0, np.int64)
        n = len(data)
        opens = np.zeros(n, bool)
        opens[:-1] = _OPENS[data[1:]]
        closes = np.zeros(n, bool)
        closes[1:] = _ASCII[data[:-1]]
        closes[2:] |= (data[:-2] >= 0xC3) & (data[:-2] < 0xE0) & (data[1:-1] >= 0x80)
        single = opens & closes
        begins = np.zeros(n + 1, bool)
        begins[offsets[:-1]] = True
        begins[:-1] |= single & ((data == 32) | (data == 10))
        begins[1:] |= single & (data == 10)
        starts = np.flatnonzero(begins[:-1])
        ends = np.append(starts[1:], n)
        keys, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self.clear()
        where = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = where < len(self.keys)
        known[inside] = self.keys[where[inside]] == keys[inside]
        if not known.all():
            new = first[~known]
            raw = data.tobytes()
            self._learn(keys[~known], [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            where = np.searchsorted(self.keys, keys)
        where = where[inverse]
        sizes = self.size[where]
        total = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.at[where] - (total - sizes), sizes) + np.arange(total[-1])]
        owner = np.searchsorted(offsets, starts, "right") - 1
        counts = np.bincount(owner, weights=sizes, minlength=texts).astype(np.int64)
        return ids, counts, total[_STOPS[data[ends - 1]]]


def cuts(places: np.ndarray, penalties: np.ndarray, capacity: int, closed: bool) -> list[int]:
    """Indexes into ``places`` of the least costly window ends, the last place always among them.

    ``places`` rise from 0 by at most ``capacity``. If the stretch goes on (not
    ``closed``), the padding of its last window is not counted.
    """
    spots, costs = places.tolist(), penalties.tolist()
    best, before = [0.0] * len(spots), [0] * len(spots)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])  # (best + place) rising, with the index
    last = len(spots) - 1
    for j in range(1, last + 1):
        here = spots[j]
        while here - spots[queue[0][1]] > capacity:
            queue.popleft()
        value, i = queue[0]
        if j == last and not closed:  # the open window pads nothing: take the cheapest start in reach
            i = min((i for _, i in queue), key=lambda i: (best[i], i))
            before[j] = i
            break
        before[j] = i
        best[j] = cost = value + capacity - here + costs[j]
        key = cost + here
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, j))
    ends = [last]
    while before[ends[-1]]:
        ends.append(before[ends[-1]])
    return ends[::-1]


class Packer:
    """Packs a stream of documents; memory holds one stretch of tokens at a time."""

    def __init__(self, capacity: int, sentence: float, inside: float, stretch: int, first: int):
        self.capacity, self.sentence, self.inside, self.stretch = capacity, sentence, inside, stretch
        self.sequence, self.spare = first, 64
        self.ids = np.zeros(0, np.uint32)
        self.docs: list[tuple] = []  # (doc_id, first place, tokens), in order; places count from the stretch
        self.stops = np.zeros(0, np.int64)

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray, stops: np.ndarray) -> Iterator[dict]:
        base = len(self.ids)
        self.ids = np.concatenate((self.ids, ids))
        self.stops = np.concatenate((self.stops, stops + base))
        firsts = base + np.concatenate(([0], np.cumsum(counts)))[:-1]
        self.docs += zip(doc_ids, firsts.tolist(), counts.tolist())
        if len(self.ids) >= self.stretch:
            yield from self.pack(closed=False)

    def pack(self, closed: bool) -> Iterator[dict]:
        n = len(self.ids)
        if not n:
            return
        doc_ends = np.array([a + k for _, a, k in self.docs], np.int64)
        places = np.unique(np.concatenate(([0], self.stops[(self.stops > 0) & (self.stops < n)], doc_ends)))
        gaps = np.diff(places)
        step = max(1, self.capacity // 32)
        wide = np.flatnonzero(gaps > 2 * step)  # long sentences can be cut inside as well, at a higher penalty
        extra = [np.arange(places[g] + step, places[g + 1], step) for g in wide]
        inner = np.concatenate(extra) if extra else np.zeros(0, np.int64)
        places = np.sort(np.concatenate((places, inner)))
        penalties = np.full(len(places), self.sentence)
        penalties[np.isin(places, doc_ends, assume_unique=False)] = 0
        penalties[np.isin(places, inner)] = self.inside
        ends = places[cuts(places, penalties, self.capacity, closed)]
        if closed:
            ends = self._tail(ends)
        else:
            ends = ends[:-1]
        if not len(ends):
            return
        yield self._pieces(ends)
        done = int(ends[-1])
        self.ids = self.ids[done:]
        self.stops = self.stops[self.stops > done] - done
        self.docs = [(d, a - done, k) for d, a, k in self.docs if a + k > done]

    def _tail(self, ends: np.ndarray) -> np.ndarray:
        """The partition's last window: powers of two need no padding, so a short rest is cut into them."""
        last = int(ends[-2]) if len(ends) > 1 else 0
        n, extra = int(ends[-1]), []
        while self.capacity - (n - last) > self.spare and (n - last) & (n - last - 1):
            last += 1 << ((n - last).bit_length() - 1)
            extra.append(last)
        return np.concatenate((ends[:-1], np.array(extra, np.int64), ends[-1:]))

    def _pieces(self, ends: np.ndarray) -> dict:
        done = int(ends[-1])
        docs = [x for x in self.docs if x[1] < done]
        firsts = np.array([x[1] for x in docs], np.int64)
        window_starts = np.concatenate(([0], ends[:-1]))
        begin = np.unique(np.concatenate((np.maximum(firsts, 0), window_starts)))
        end = np.append(begin[1:], done)
        doc = np.searchsorted(firsts, begin, "right") - 1
        window = np.searchsorted(window_starts, begin, "right") - 1
        raw = memoryview(self.ids.tobytes())
        out = {"doc_id": [docs[d][0] for d in doc], "start": begin - firsts[doc], "length": end - begin,
               "ids": [bytes(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), end.tolist())],
               "doc_tokens": np.array([x[2] for x in docs], np.int64)[doc],
               "sequence_id": self.sequence + window, "offset": begin - window_starts[window],
               "sequence_tokens": (ends - window_starts)[window]}
        self.sequence += len(ends)
        return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, sentence_penalty: float = 1.0,
         inside_penalty: float = 16.0, stretch: int = 1 << 18) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens; one row per piece.

    ``tokenizer`` is the path of a byte-level BPE file; each document's ids are followed
    by ``end_id``. ``ids`` are little-endian unsigned 32-bit. Documents keep the order they
    have in their input partition; sequences never cross partitions. A sequence whose
    length is a power of two needs no padding; others are padded to ``capacity``.

    Null and empty texts: the end id alone. Null ids, repeated ids and ties: packed as they
    are, each row a document of its own. Empty table: no rows. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in (x.split()[0] for x in PIECES.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = CachedEncoder(byte_bpe(tokenizer))
        packer = Packer(capacity, sentence_penalty, inside_penalty, stretch, TaskContext.get().partitionId() << 40)
        for batch in text_slices(batches, "_text", 2 << 20):
            ids, counts, stops = encoder(*flat_bytes(batch.column("_text")))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, np.uint32(end_id))
            stops = stops + np.searchsorted(ends, stops, "left")
            for out in packer.add(batch.column("doc_id").to_pylist(), ids, counts + 1, stops):
                yield pa.RecordBatch.from_pydict(out, schema)
        for out in packer.pack(closed=True):
            yield pa.RecordBatch.from_pydict(out, schema)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_bytes(docs).alias("_text"))
    return rows.mapInArrow(run, PIECES)


def piece_rows(pieces: DataFrame) -> DataFrame:
    """The contract's columns, with a checksum in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
