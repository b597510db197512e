"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its byte n-grams, so a misspelling or a new
ending shares most of its vectors with the words seen in training. A text is cut
into windows of a few dozen words; each window is the mean of its words and goes
through a linear softmax; the text scores as its most toxic window, so a long
text cannot dilute an insult. The model is fitted on a bounded sample of labelled
rows in one task; scoring runs wherever the documents are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lopside.llm.common import (flat_bytes, gram_hashes, guarded, lowered, small_batches, span_hashes, text_bytes,
                                text_slices, word_spans)

BUCKETS = 1 << 17
GRAMS = (3, 4, 5, 6)
WINDOW = 32


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word (with a space on both sides), and how many each word has."""
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.concatenate(([0], np.cumsum(size - 1)))[:-1]
    counts = [np.ones(len(words), np.int64), *(np.maximum(size - n + 1, 0) for n in GRAMS)]
    total = sum(counts)
    out, place = np.zeros(int(total.sum()), np.int32), np.cumsum(total) - total  # each word's n-grams stand together
    out[place] = (span_hashes(data, starts, starts + size) % np.uint64(BUCKETS)).astype(np.int32)  # the whole word
    for n, before, count in zip(GRAMS, np.cumsum(counts, axis=0), counts[1:]):
        grams = (gram_hashes(data, n) % np.uint64(BUCKETS)).astype(np.int32)
        first = np.cumsum(count) - count
        for a in range(0, len(words), 1 << 14):  # some words at a time
            b = min(a + (1 << 14), len(words))
            owner = np.repeat(np.arange(a, b), count[a:b])
            within = np.arange(len(owner)) - (first[owner] - first[a])
            out[place[owner] + before[owner] + within] = grams[starts[owner] + within]
    return out, total


def _slices(offsets: np.ndarray, size: int = 1 << 20) -> list[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes, or of one longer text."""
    out, a = [], 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        out.append((a, b))
        a = b
    return out


def _slice_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Hashes of the distinct words, the words, and for each word in order its number and its text."""
    data = lowered(data)
    starts, ends, owner = word_spans(data, offsets)
    keys, first, number = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    raw = data.tobytes()
    words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    return keys, words, number.astype(np.int32), owner.astype(np.int32)


def text_words(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW):
    """Distinct words; pairs of word number and window, window by window; and the text of each window."""
    parts = [_slice_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in _slices(offsets)]
    keys, first = np.unique(np.concatenate([np.zeros(0, np.uint64), *(p[0] for p in parts)]), return_index=True)
    words = [w for p in parts for w in p[1]]
    words = [words[k] for k in first.tolist()]
    number = np.concatenate([np.zeros(0, np.int32), *(np.searchsorted(keys, p[0]).astype(np.int32)[p[2]] for p in parts)])
    owner = np.concatenate([np.zeros(0, np.int32), *(p[3] + np.int32(a) for p, (a, _) in zip(parts, _slices(offsets)))])
    texts = len(offsets) - 1
    per_text = np.bincount(owner, minlength=texts)
    place = np.arange(len(owner)) - (np.cumsum(per_text) - per_text)[owner]
    windows = np.where(per_text > 0, np.maximum(per_text // window, 1), 0)  # a rest joins the last window
    before = np.cumsum(windows) - windows
    which = before[owner] + np.minimum(place // window, windows[owner] - 1)
    del place
    once = np.unique(which * max(len(words), 1) + number)  # a word counts once in a window, however often it stands there
    return (keys, words, (once % max(len(words), 1)).astype(np.int32), (once // max(len(words), 1)).astype(np.int32),
            np.repeat(np.arange(texts), windows))


def bag_size(words: np.ndarray) -> np.ndarray:
    """What a bag's sum is divided by: a few words alone count as if neutral ones stood beside them."""
    return np.maximum(words, WINDOW // 2)


def _means(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Means of consecutive stretches, each of one value at least."""
    return np.add.reduceat(values, np.cumsum(count) - count, axis=0) / count.reshape(-1, *[1] * (values.ndim - 1))


def _scatter(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(index, weights=values[:, d], minlength=size) for d in range(values.shape[1])], axis=1)


def _chunks(count: np.ndarray, most: int = 1 << 18) -> list[tuple[int, int, int, int]]:
    """Ranges of words and of their n-grams, which stand word after word; work arrays are as large as one range."""
    ends = np.cumsum(count)
    cuts = np.unique([0, *(np.searchsorted(ends, np.arange(most, int(count.sum()), most), "left") + 1), len(count)]).tolist()
    return [(a, b, int(ends[a] - count[a]), int(ends[b - 1])) for a, b in zip(cuts[:-1], cuts[1:])]


def gram_sums(grams: np.ndarray, count: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """For each n-gram the sum of the values of the words that have it."""
    out = np.zeros(size)
    for a, b, low, high in _chunks(count):
        out += np.bincount(grams[low:high], weights=np.repeat(values[a:b], count[a:b]), minlength=size)
    return out


def word_sums(grams: np.ndarray, count: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each word the sum of its n-grams' values."""
    out = np.zeros((len(count), *values.shape[1:]))
    for a, b, low, high in _chunks(count):
        own = a + np.flatnonzero(count[a:b])
        if len(own):
            out[own] = np.add.reduceat(values[grams[low:high]], np.cumsum(count[own]) - count[own], axis=0)
    return out


class Trainer:
    """Vectors and softmax, moved together by gradient steps with momentum over bags of words.

    A step is scaled by the largest entry of its matrix, not entry by entry: an n-gram moves
    as far as the texts agree on it, so rare words stay where they are.
    """

    def __init__(self, grams: np.ndarray, known: np.ndarray, per_word: np.ndarray, dims: int,
                 rate: tuple[float, float, float]):
        self.grams, self.per_word, self.rate = grams, per_word, rate
        self.known = known  # n-grams in use, by word
        self.first = np.cumsum(self.known) - self.known
        random = np.random.default_rng(7)
        size = int(grams.max()) + 1 if len(grams) else 0
        self.params = [random.normal(0, 0.01, (size, dims)), random.normal(0, 0.5, (dims, 2)), np.zeros(2)]
        self.moments = [np.zeros_like(p) for p in self.params]

    def word_margins(self) -> np.ndarray:
        """Each word's log-odds, before the mean over its window."""
        table, softmax, _ = self.params
        return word_sums(self.grams, self.known, table @ (softmax[:, 1] - softmax[:, 0])) / self.per_word

    def rounds(self, n: int, bag_words: np.ndarray, per_bag: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> None:
        """``n`` steps over all bags; a bag is the mean of its words, a word the mean of its n-grams."""
        words, number = np.unique(bag_words, return_inverse=True)
        count = self.known[words]
        at = np.repeat(self.first[words] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        used, grams = np.unique(self.grams[at], return_inverse=True)
        size = self.per_word[words]
        bag = np.repeat(np.arange(len(per_bag)), per_bag)
        table, softmax, bias = self.params[0][used], *self.params[1:]
        moments = [self.moments[0][used], *self.moments[1:]]
        grams = grams.astype(np.int32)
        for _ in range(n):
            word = word_sums(grams, count, table) / size[:, None]
            bags = np.add.reduceat(word[number], np.cumsum(per_bag) - per_bag, axis=0) / bag_size(per_bag)[:, None]
            logits = bags @ softmax + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            error = (p - truth) * weight[:, None]
            back = (error @ softmax.T) / bag_size(per_bag)[:, None]
            per_word = _scatter(number, back[bag], len(words)) / size[:, None]
            moved = np.stack([gram_sums(grams, count, per_word[:, d], len(used)) for d in range(table.shape[1])], axis=1)
            grads = [moved, bags.T @ error, error.sum(0)]
            values = [table, softmax, bias]
            for k, (g, m) in enumerate(zip(grads, moments)):
                m *= 0.8
                m += g
                values[k] = values[k] - self.rate[k] * m / (np.abs(m).max() + 1e-12)
            table, softmax, bias = values
        self.params[0][used] = table
        self.moments[0][used] = moments[0]
        self.params[1:] = [softmax, bias]


def fit(texts: pa.Array, labels: np.ndarray, dims: int = 4, turns: int = 10, rounds: int = 12,
        rate: tuple[float, float, float] = (0.05, 0.1, 0.1), support: int = 4) -> tuple[np.ndarray, float]:
    """Train vectors and softmax together; returns each bucket's log-odds and the bias.

    The vectors start from how the n-grams are shared out between the classes. Then, ``turns``
    times, the most toxic window of each text is found and all weights are trained for some
    rounds on these windows; clean texts keep the windows of earlier turns as well. N-grams whose words turn up in fewer than ``support``
    texts stay at zero, so that a rare word cannot stand for its text.
    """
    share = float(np.clip(labels.mean() if len(labels) else 0.0, 0.01, 0.99))
    nothing = np.zeros(BUCKETS), float(np.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        return nothing
    _, words, number, window, text_of = text_words(*flat_bytes(texts))
    if not len(words):
        return nothing
    grams, per_word = word_grams(words)
    in_texts = np.bincount(np.unique(number * np.int64(len(labels)) + text_of[window]) // len(labels), minlength=len(words))
    common = gram_sums(grams, per_word, in_texts, BUCKETS) >= support
    kept = common[grams]
    if not kept.any():
        return nothing
    used, numbered = np.flatnonzero(common), (np.cumsum(common) - 1).astype(np.int32)
    known_grams = np.add.reduceat(kept, np.cumsum(per_word) - per_word, dtype=np.int64)
    grams = numbered[grams[kept]]
    trainer = Trainer(grams, known_grams, per_word, dims, rate)
    per_window = np.bincount(window, minlength=len(text_of))
    first_word = np.cumsum(per_window) - per_window
    per_text = np.bincount(text_of, minlength=len(labels))
    known = np.flatnonzero(per_text)
    first_window = (np.cumsum(per_text) - per_text)[known]

    def learn(n: int, bag_words: np.ndarray, per_bag: np.ndarray, text: np.ndarray) -> None:
        truth = np.eye(2)[labels[text]]
        trainer.rounds(n, bag_words, per_bag, truth, (0.5 / truth.sum(0).clip(1))[labels[text]])

    # Start: one dimension holds the log-odds of each n-gram's share of toxic and of clean texts,
    # where the two shares differ by more than chance.
    classes = np.bincount(labels, minlength=2)
    pair = np.unique(number * np.int64(len(labels)) + text_of[window])
    toxic = labels[pair % len(labels)] == 1
    by_class = [np.bincount(pair[k] // len(labels), minlength=len(words)) for k in (~toxic, toxic)]
    clean_share, toxic_share = (gram_sums(grams, known_grams, x, len(used)) / n for x, n in zip(by_class, classes))
    middle = np.clip((clean_share * classes[0] + toxic_share * classes[1]) / len(labels), 1 / len(labels), None)
    sure = np.abs(toxic_share - clean_share) / np.sqrt(middle * (1 / classes[0] + 1 / classes[1]))
    odds = np.log((toxic_share + 0.5 / classes[1]) / (clean_share + 0.5 / classes[0]))
    trainer.params[0][:, 0] = odds * (sure > 2.5)
    trainer.params[1][0] = [-WINDOW / 4, WINDOW / 4]
    hard = np.zeros(0, np.int64)
    for _ in range(turns):
        margin = np.bincount(window, weights=trainer.word_margins()[number]) / bag_size(per_window)
        order = np.lexsort((-margin, text_of))
        top = order[first_window]  # windows are numbered text by text, so each text's best comes first
        clean = labels[text_of[top]] == 0
        hard = np.unique(np.concatenate((hard, top[clean])))
        bags = np.concatenate((top[~clean], hard))
        at = np.repeat(first_word[bags] - (np.cumsum(per_window[bags]) - per_window[bags]), per_window[bags])
        learn(rounds, number[at + np.arange(len(at))], per_window[bags], text_of[bags])
    weights = np.zeros(BUCKETS)
    weights[used] = trainer.params[0] @ (trainer.params[1][:, 1] - trainer.params[1][:, 0])
    return weights, float(trainer.params[2][1] - trainer.params[2][0])


class Scorer:
    """Log-odds of texts; each different word is worked out once and kept by its hash."""

    def __init__(self, weights: np.ndarray, bias: float, limit: int = 1_000_000):
        self.weights, self.bias, self.limit = weights, bias, limit
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        keys, words, number, window, text_of = text_words(*flat_bytes(texts))
        out = np.full(len(texts), self.bias)
        if not len(words):
            return out
        if len(self.keys) + len(keys) > self.limit:
            self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0)
        where = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = where < len(self.keys)
        known[inside] = self.keys[where[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            grams, per_word = word_grams([words[k] for k in new])
            self.values = np.insert(self.values, where[new], _means(self.weights[grams], per_word))
            self.keys = np.insert(self.keys, where[new], keys[new])
        value = self.values[np.searchsorted(self.keys, keys)][number]
        margin = np.bincount(window, weights=value) / bag_size(np.bincount(window))
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, text_of, margin)
        return np.where(np.isfinite(best), best + self.bias, out)


def held_out(doc_id):
    """Rows that are never learned from: a fifth of the ids by their checksum."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = 2000, clean_rows: int = 3000) -> tuple[bytes, float]:
    """Fit on at most ``toxic_rows`` and ``clean_rows`` labelled rows, those least by a hash of their id.

    The sample is bounded, so one task fits the model; the driver gets its fixed-size weights.
    A document labelled more than once counts as toxic if any label says so; null labels don't count. Of a repeated
    doc_id one text is used, that of the least hash.
    """
    known = (labels.filter(labels["doc_id"].isNotNull() & labels["toxic"].isNotNull())
             .filter(~held_out(labels["doc_id"])).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    ids = known.withColumn("_order", F.xxhash64("doc_id"))
    picked = (ids.filter("toxic = 1").orderBy("_order", "doc_id").limit(toxic_rows)
              .union(ids.filter("toxic = 0").orderBy("_order", "doc_id").limit(clean_rows)))
    texts = docs.select("doc_id", text_bytes(docs).alias("_text"))
    # The sampled ids are few by the bounds above, so they can go to every task.
    sample = texts.join(F.broadcast(picked.select("doc_id", "toxic")), "doc_id")
    # An id that stands for several texts is learned from one of them, so the rows stay within the bounds.
    sample = (sample.groupBy("doc_id", "toxic").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), F.col("_text"))).alias("_text"))
              .select("doc_id", "_text", "toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            # The order of arrival must not matter.
            rows = pa.Table.from_batches(held).sort_by([("doc_id", "ascending"), ("_text", "ascending")])
            weights, bias = fit(rows["_text"].combine_chunks() if rows["_text"].num_chunks != 1 else rows["_text"].chunk(0),
                                rows["toxic"].to_numpy().astype(np.int64))
        else:
            weights, bias = fit(pa.array([], pa.binary()), np.zeros(0, np.int64))
        yield pa.RecordBatch.from_pydict({"weights": [weights.astype("<f4").tobytes()], "bias": [bias]})

    row = sample.repartition(1).mapInArrow(run, "weights binary, bias double").head()
    if row is None:
        weights, bias = fit(pa.array([], pa.binary()), np.zeros(0, np.int64))
        return weights.astype("<f4").tobytes(), bias
    return bytes(row["weights"]), row["bias"]


def score(docs: DataFrame, model: tuple[bytes, float], to: str = "score") -> DataFrame:
    """Add each document's toxicity between 0 and 1, and ``held_out``; the other columns stay.

    Only the text is looked at, the whole of it. Null and empty texts score as the bias alone.
    Repeated rows score alike; an empty table gives no rows; columns named like ``to`` or
    ``held_out`` are replaced.
    """
    small_batches(docs.sparkSession)
    weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # BUCKETS floats, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(np.frombuffer(shared.value, "<f4").astype(float), bias)
        for batch in text_slices(batches, "_text", 2 << 20):
            p = 1 / (1 + np.exp(-np.clip(scorer(batch.column("_text")), -500, 500)))
            yield batch.drop_columns(["_text"]).append_column("_score", pa.array(p))

    given, names = guarded(docs, "doc_id", "text")
    rows = given.withColumn("_text", text_bytes(given))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields)
    out = rows.mapInArrow(run, f"{fields}, _score double").withColumn("_held_out", held_out(F.col("doc_id")))
    kept = [F.col(new).alias(c) for c, new in names.items() if c not in (to, "held_out")]
    return out.select(*kept, F.col("_score").alias(to), F.col("_held_out").alias("held_out"))


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document by a model trained on the labels, with the decision at one half."""
    model = train(docs, labels)
    return (score(docs.select("doc_id", "text"), model)
            .select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
