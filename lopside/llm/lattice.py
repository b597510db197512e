"""LM scoring: the likelihood of a text over all its segmentations into an existing vocabulary's pieces.

A word's probability under the pieces is the sum over every way to cut it up, by a
forward recursion in log space. The vocabulary's scores give the pieces' first
weights, and one round of expected counts over the training words refines them. The
corpus also teaches whole words: with N tokens and V distinct words seen, a word of
count c has probability ((c - d)+ + d V P_lattice(word)) / N, with d from the numbers
of words seen once and twice, so all mass that counting takes away goes to the lattice.

Words are never joined one by one. Documents are read in blocks; a block's distinct
words go to buckets by hash, every bucket counts and scores its words once for the
whole corpus, and the values go back to the blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lopside.llm.common import small_batches, stored, text_bytes, text_slices

BUCKETS = 4096
BLOCK_BYTES = 16 << 20
START, STOP = b" ", b"\n"  # neither byte occurs in a word
_LATTICES: dict = {}


class Lattice:
    """The pieces of a vocabulary as a byte trie, and all segmentations of many words at once.

    A word runs from START to STOP. Pieces that begin a word and all others (STOP among
    them) are two distributions of their own, so words have probabilities that sum to one.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        weight: dict[bytes, float] = {bytes([b]): 1e-5 for b in range(256) if b not in (9, 10, 11, 12, 13, 32)}
        weight |= {START: 1e-3, STOP: 1.0}
        for k in range(model.get_piece_size()):
            if model.is_control(k) or model.is_unknown(k) or model.is_byte(k):
                continue
            piece = model.id_to_piece(k).replace("▁", " ").encode()
            # No capitals, and white space at most as the one space that begins a word.
            if piece.lower() == piece and piece[1:].split() == [piece[1:]] and (piece[:1] == START or piece[:1].split()):
                weight[piece] = 1 / (10 - model.get_score(k))  # the scores are ranks: a Zipf law gives weights
        self.pieces = list(weight)
        self.starting = np.array([p[:1] == START for p in self.pieces])
        first = np.array(list(weight.values()))
        self.prior = np.where(self.starting, first / first[self.starting].sum(), first / first[~self.starting].sum())
        children: list[dict[int, int]] = [{}]
        self.piece_at = [-1]
        for number, piece in enumerate(self.pieces):
            at = 0
            for byte in piece:
                if byte not in children[at]:
                    children[at][byte] = len(children)
                    children.append({})
                    self.piece_at.append(-1)
                at = children[at][byte]
            self.piece_at[at] = number
        self.piece_at = np.array(self.piece_at, np.int32)
        self.next = np.zeros(len(children) * 256, np.int32)
        for at, row in enumerate(children):
            for byte, to in row.items():
                self.next[at * 256 + byte] = to

    def _edges(self, words: list[bytes]):
        """All pieces that match somewhere: start, end and number, and each position's place in its word."""
        data = np.frombuffer(START + (STOP + START).join(words) + STOP, np.uint8)
        size = np.fromiter(map(len, words), np.int64, len(words)) + 2
        first = np.cumsum(size) - size
        at, state, starts, ends, pieces, length = np.arange(len(data)), np.zeros(len(data), np.int64), [], [], [], 0
        while len(at):
            length += 1
            inside = at + length <= len(data)
            at, state = at[inside], state[inside]
            state = self.next[state * 256 + data[at + length - 1]].astype(np.int64)
            at, state = at[state > 0], state[state > 0]
            piece = self.piece_at[state]
            hit = piece >= 0
            starts.append(at[hit])
            ends.append(at[hit] + length)
            pieces.append(piece[hit])
        # Positions of the lattice: one more than bytes in each word.
        place = np.arange(len(data) + len(words)) - np.repeat(first + np.arange(len(words)), size + 1)
        word = np.repeat(np.arange(len(words)), size)
        start, end, piece = np.concatenate(starts), np.concatenate(ends), np.concatenate(pieces)
        shift = word[start]
        return start + shift, end + shift, piece, place, first + np.arange(len(words)), first + size + np.arange(len(words))

    @staticmethod
    def _sweep(total: np.ndarray, frm: np.ndarray, to: np.ndarray, gain: np.ndarray, step: np.ndarray) -> None:
        """total[to] = logsum of total[frm] + gain, in rising ``step``, which puts ``frm`` before ``to``."""
        order = np.argsort(step * np.int64(len(total)) + to, kind="stable")
        frm, to, gain, step = frm[order], to[order], gain[order], step[order]
        bounds = np.append(np.flatnonzero(np.append(True, step[1:] != step[:-1])), len(step))
        new = np.append(True, to[1:] != to[:-1])
        for a, b in zip(bounds[:-1], bounds[1:]):
            cut = np.flatnonzero(new[a:b])
            total[to[a:b][cut]] = np.logaddexp.reduceat(total[frm[a:b]] + gain[a:b], cut)

    def log_likelihood(self, words: list[bytes], log_weight: np.ndarray) -> np.ndarray:
        """Natural log probability of each word: the forward recursion's value at its end."""
        start, end, piece, place, first, last = self._edges(words)
        forward = np.full(len(place), -np.inf)
        forward[first] = 0
        self._sweep(forward, start, end, log_weight[piece], place[end])
        return forward[last]

    def expected(self, words: list[bytes], count: np.ndarray, log_weight: np.ndarray) -> np.ndarray:
        """How often each piece is used, over all segmentations of the words, weighted by ``count``."""
        start, end, piece, place, first, last = self._edges(words)
        forward, backward = np.full(len(place), -np.inf), np.full(len(place), -np.inf)
        forward[first] = backward[last] = 0
        self._sweep(forward, start, end, log_weight[piece], place[end])
        self._sweep(backward, end, start, log_weight[piece], place.max() - place[start])
        word = np.searchsorted(first, start, "right") - 1
        share = np.exp(forward[start] + log_weight[piece] + backward[end] - forward[last][word]) * count[word]
        return np.bincount(piece, weights=share, minlength=len(self.pieces))

    def refined(self, counts: np.ndarray, strength: float = 100.0) -> np.ndarray:
        """Weights from expected counts, with the vocabulary's own as if seen ``strength`` times."""
        total = np.where(self.starting, counts[self.starting].sum(), counts[~self.starting].sum())
        return (counts + strength * self.prior) / (total + strength)


def lattice(path: str) -> Lattice:
    """Built once in each Python worker."""
    if path not in _LATTICES:
        _LATTICES[path] = Lattice(path)
    return _LATTICES[path]


def held_out(doc_id):
    """Rows that are never learned from: a seventh of the ids by their checksum."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Two kinds of rows: a block's words of one bucket with their training counts, and its documents.

    kind 0: bucket, words (one per line), counts (uint32). kind 1: doc_id, held_out and the numbers of
    its words in the block (uint32), which count the block's words bucket by bucket.
    """
    schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("bucket", pa.int32()), ("doc_id", pa.int64()),
                        ("held_out", pa.bool_()), ("words", pa.binary()), ("numbers", pa.binary())])

    def flush(block: int, words: dict[bytes, int], counts: np.ndarray, rows: list) -> Iterator[pa.RecordBatch]:
        listed = list(words)
        bucket = np.fromiter((zlib.crc32(w) % BUCKETS for w in listed), np.int32, len(listed))
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(listed), np.uint32)
        place[order] = np.arange(len(listed), dtype=np.uint32)
        cut = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)) if len(listed) else np.zeros(0, np.int64)
        out = [(0, block, int(bucket[order[a]]), None, None, b"\n".join([listed[k] for k in order[a:b]]),
                counts[order[a:b]].astype("<u4").tobytes()) for a, b in zip(cut, np.append(cut[1:], len(listed)))]
        out += [(1, block, -1, doc_id, held, None, place[numbers].astype("<u4").tobytes()) for doc_id, held, numbers in rows]
        for at in range(0, len(out), 2000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[at:at + 2000]), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held_bytes = TaskContext.get().partitionId() << 24, 0
        words: dict[bytes, int] = {}
        rows, trained = [], []
        for batch in text_slices(batches, "_text"):
            for doc_id, held, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "held_out", "_text"))):
                numbers = np.array([words.setdefault(w, len(words)) for w in text.lower().split()], np.int64)
                rows.append((doc_id, held, numbers))
                if not held:
                    trained.append(numbers)
                held_bytes += len(text)
                if held_bytes >= block_bytes:
                    yield from flush(block, words, _counts(trained, len(words)), rows)
                    block, held_bytes, words, rows, trained = block + 1, 0, {}, [], []
        if rows:
            yield from flush(block, words, _counts(trained, len(words)), rows)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), text_bytes(docs).alias("_text"))
    return rows.mapInArrow(run, "kind int, block long, bucket int, doc_id long, held_out boolean, words binary, numbers binary")


def _counts(numbers: list[np.ndarray], size: int) -> np.ndarray:
    return np.bincount(np.concatenate(numbers), minlength=size) if numbers else np.zeros(size, np.int64)


def _grouped(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows that stand together with the same value of ``column``."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for value, group in groupby(rows, key=lambda row: row[column]):
        yield value, list(group)


def _merged(rows: list[dict]) -> tuple[list[bytes], np.ndarray, list[np.ndarray]]:
    """Distinct words of a bucket's rows, their counts over all blocks, and each row's words as numbers."""
    words: dict[bytes, int] = {}
    numbers = [np.array([words.setdefault(w, len(words)) for w in row["words"].split(b"\n")], np.int64) for row in rows]
    counts = np.bincount(np.concatenate(numbers), minlength=len(words),
                         weights=np.concatenate([np.frombuffer(row["numbers"], "<u4") for row in rows]))
    return list(words), counts.astype(np.int64), numbers


def _by_bucket(words: DataFrame) -> DataFrame:
    rows = words.select("bucket", "block", "words", "numbers")
    return rows.repartition("bucket").sortWithinPartitions("bucket", "block")


def distinct_words(words: DataFrame) -> DataFrame:
    """(bucket, words, counts, total, seen, once, twice): each training word once, and sums over the bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _grouped(batches, "bucket"):
            listed, counts, _ = _merged(rows)
            known = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([bucket], pa.int32()), "words": [b"\n".join([listed[k] for k in known])],
                "counts": [counts[known].astype("<i8").tobytes()], "total": [int(counts.sum())], "seen": [len(known)],
                "once": [int((counts == 1).sum())], "twice": [int((counts == 2).sum())]})

    return _by_bucket(words).mapInArrow(run, "bucket int, words binary, counts binary, total long, seen long, once long, twice long")


def piece_counts(distinct: DataFrame, path: str, log_weight: np.ndarray, at_once: int = 50_000) -> np.ndarray:
    """Expected piece counts over all training words; the driver gets one number for each piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, counts = None, [], []

        def add():
            nonlocal total, held, counts
            found = lattice(path).expected(held, np.concatenate(counts), log_weight)
            total, held, counts = found if total is None else total + found, [], []

        for batch in batches:
            for words, n in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist()):
                if words:
                    held += words.split(b"\n")
                    counts.append(np.frombuffer(n, "<i8"))
                    if len(held) >= at_once:
                        add()
        if held:
            add()
        if total is not None:
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "n"])

    rows = distinct.select("words", "counts").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    out = np.zeros(len(log_weight))
    for row in rows.collect():  # as many rows as the vocabulary has pieces
        out[row["piece"]] = row["n"]
    return out


def word_values(words: DataFrame, path: str, log_weight: np.ndarray, tokens: int, seen: int, discount: float) -> DataFrame:
    """(block, bucket, counts, scores): for each block's words their training counts and log10 probabilities."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, listed = [], []

        def done() -> pa.RecordBatch:
            spelled = lattice(path).log_likelihood(listed, log_weight)
            out, at = ([], [], [], []), 0
            for bucket, rows, counts, numbers in waiting:
                score = spelled[at:at + len(counts)]
                if tokens:
                    with np.errstate(divide="ignore"):
                        score = np.logaddexp(np.log(np.maximum(counts - discount, 0) / tokens), np.log(discount * seen / tokens) + score)
                else:
                    score = score + np.log(0.5)
                score, at = (score / np.log(10)).astype("<f4"), at + len(counts)
                for row, k in zip(rows, numbers):
                    for column, value in zip(out, (row["block"], bucket, counts[k].astype("<u4").tobytes(), score[k].tobytes())):
                        column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary()),
                                               pa.array(out[3], pa.binary())], names=["block", "bucket", "counts", "scores"])

        for bucket, rows in _grouped(batches, "bucket"):
            found, counts, numbers = _merged(rows)
            listed = listed + found
            waiting.append((bucket, rows, counts, numbers))
            if len(listed) >= 50_000:
                yield done()
                waiting, listed = [], []
        if waiting:
            yield done()

    return _by_bucket(words).mapInArrow(run, "block long, bucket int, counts binary, scores binary")


def score(docs: DataFrame, vocabulary: str, rounds: int = 1) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``vocabulary`` is the path of a sentencepiece model, whose scores weight the pieces. Words are runs
    of bytes other than ASCII white space, A-Z in lower case; every text ends with an end token. Learns
    from the rows that are not ``held_out``. Null and empty texts are the end token alone; null ids are
    learned from; repeated rows count and score once each; other columns are ignored; an empty table
    gives no rows. Without training rows the lattice alone scores.
    """
    small_batches(docs.sparkSession)
    table = stored(blocks(docs))
    words, rows = table.filter("kind = 0"), table.filter("kind = 1")
    distinct = stored(distinct_words(words))
    sums = distinct.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "seen", "once", "twice")]).head()
    ends = rows.filter("not held_out").count()
    tokens, seen = sums["total"] + ends, sums["seen"] + (ends > 0)
    once, twice = sums["once"] + (ends == 1), sums["twice"] + (ends == 2)
    discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
    model = lattice(vocabulary)
    weight = model.prior
    for _ in range(rounds if tokens else 0):
        weight = model.refined(piece_counts(distinct, vocabulary, np.log(weight)))
    values = word_values(words, vocabulary, np.log(weight), tokens, seen, discount)
    end_score = np.log10(max(ends - discount, discount / 2) / tokens) if tokens else np.log10(0.5)
    end_base = np.log10((ends + 1) / (tokens + seen + 1))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), *((n, pa.int64()) for n in names[2:5]),
                        *((n, pa.float64()) for n in names[5:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts, scores, base, out = None, [], [], None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != block:
                    block, counts, scores, base = row["block"], [], [], None
                if row["bucket"] >= 0:
                    counts.append(np.frombuffer(row["counts"], "<u4"))
                    scores.append(np.frombuffer(row["scores"], "<f4"))
                    continue
                if base is None:
                    count = np.concatenate(counts).astype(np.int64) if counts else np.zeros(0, np.int64)
                    value = np.concatenate(scores).astype(np.float64) if scores else np.zeros(0)
                    base, known = np.log10((count + 1) / (tokens + seen + 1)), count > 0
                    counts, scores = [], []
                k = np.frombuffer(row["numbers"], "<u4")
                out.append((row["doc_id"], row["held_out"], len(k) + 1, int(known[k].sum()) + (ends > 0), tokens,
                            float(base[k].sum() + end_base), float(value[k].sum() + end_score)))
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    none = F.lit(None)
    both = (values.select("block", "bucket", none.cast("long").alias("doc_id"), none.cast("boolean").alias("held_out"),
                          none.cast("binary").alias("numbers"), "counts", "scores")
            .union(rows.select("block", F.lit(BUCKETS).alias("bucket"), "doc_id", "held_out", "numbers",
                               none.cast("binary"), none.cast("binary"))))
    ready = both.repartition("block").sortWithinPartitions("block", "bucket")
    ready = ready.withColumn("bucket", F.when(F.col("bucket") == BUCKETS, -1).otherwise(F.col("bucket")))
    return ready.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                 "base_score double, score double")
