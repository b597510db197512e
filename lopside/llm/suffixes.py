"""Suffix arrays by induced sorting, in numpy.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour.
The leftmost S suffixes (LMS) are put into their buckets, one sweep up induces the
order of the L suffixes and one sweep down that of the S suffixes. A first round
sorts the LMS substrings, which get names; if names repeat, the shorter string of
names is sorted in the same way; a second round induces the whole array.

A sweep takes one symbol's bucket at a time, all its entries at once. Strings of
names with a large alphabet, whose buckets hold little, are sorted by doubling instead.
"""

from __future__ import annotations

import numpy as np

SWEEP_SYMBOLS = 1024


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Starts of the suffixes of an array of non-negative integers, in lexicographic order.

    With ``depth``, suffixes that agree in so many symbols may stand in any order among themselves.
    """
    text = np.append(text.astype(np.int64) + 1, 0)  # a least symbol of its own at the end
    return _sorted(text, depth)[1:]


def _sorted(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    n = len(text)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    symbols = int(text.max()) + 1
    if symbols > SWEEP_SYMBOLS:
        return doubling(text, depth)
    smaller = _smaller(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if not len(lms):
        lms = np.array([n - 1])
    order = _induced(text, smaller, lms, symbols)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = order[is_lms[order]]
    names = _names(text, smaller, lms, order)
    if names.max() + 1 < len(lms):
        # LMS places are two symbols apart at least.
        order = lms[_sorted(names, None if depth is None else depth // 2 + 2)]
    return _induced(text, smaller, order, symbols)


def _smaller(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next; the last one is."""
    n = len(text)
    differs = np.append(text[1:] != text[:-1], True)
    until = np.where(differs, np.arange(n), n)
    until = np.minimum.accumulate(until[::-1])[::-1]  # the next place whose right neighbour differs
    return np.where(until == n - 1, True, text[until] < text[np.minimum(until + 1, n - 1)])


def _induced(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes in order, from the LMS suffixes in order (or, of a first round, in any order)."""
    n = len(text)
    size = np.bincount(text, minlength=symbols)
    ends = np.cumsum(size)
    starts = ends - size
    larger_size = np.bincount(text[~smaller], minlength=symbols)
    out = np.full(n, -1, np.int64)
    by = np.argsort(text[lms], kind="stable")
    seeds = lms[by]
    seed_cut = np.searchsorted(text[seeds], np.arange(symbols + 1))
    head = starts.copy()

    def push(found: np.ndarray, up: bool, c: int) -> np.ndarray:
        """Put predecessors into their buckets in order; returns those that belong to the bucket at hand."""
        symbol = text[found]
        grouped = np.argsort(symbol, kind="stable")
        found, symbol = found[grouped], symbol[grouped]
        count = np.bincount(symbol, minlength=symbols)
        place = np.arange(len(found)) - (np.cumsum(count) - count)[symbol]
        if up:
            out[head[symbol] + place] = found
            head[:] += count
        else:
            out[head[symbol] - 1 - place] = found
            head[:] -= count
        return found[symbol == c]

    for c in range(symbols):  # up: L suffixes, from those before them
        todo = out[starts[c]:head[c]]
        for own in (True, False):
            todo = todo if own else seeds[seed_cut[c]:seed_cut[c + 1]]
            while len(todo):
                before = todo[todo > 0] - 1
                before = before[~smaller[before]]
                todo = push(before, True, c) if len(before) else before
    head = ends.copy()
    for c in range(symbols - 1, -1, -1):  # down: S suffixes, from those after them
        todo = out[head[c]:ends[c]][::-1]
        if c == 0:
            out[0] = n - 1
            continue
        for own in (True, False):
            todo = todo if own else out[starts[c]:starts[c] + larger_size[c]][::-1]
            while len(todo):
                before = todo[todo > 0] - 1
                before = before[smaller[before]]
                todo = push(before, False, c) if len(before) else before
    return out


def _names(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The rank of each LMS substring, in the order of the text; equal substrings share one."""
    end = np.append(lms[1:], lms[-1])  # a substring reaches to the next LMS place
    length = (end - lms)[np.searchsorted(lms, order)]
    differs = np.append(True, length[1:] != length[:-1])
    same = np.flatnonzero(~differs)
    step = 0
    while len(same):
        a, b = order[same] + step, order[same - 1] + step
        apart = text[a] != text[b]
        differs[same[apart]] = True
        same = same[~apart & (step < length[same])]
        step += 1
    rank = np.empty(len(order), np.int64)
    rank[np.searchsorted(lms, order)] = np.cumsum(differs) - 1
    return rank


def doubling(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Ranks by prefixes of 1, 2, 4, ... symbols, until all differ (or the prefixes reach ``depth``)."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.append(0, np.cumsum(key[order][1:] != key[order][:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or (depth is not None and step >= depth):
            return order


def permuted_prefixes(data: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each place of ``order``, the bytes its suffix shares with the one before it in ``order``, up to ``limit``.

    All suffixes of ``order`` must have ``limit`` bytes. Eight bytes are compared at a time.
    """
    padded = np.append(data, np.zeros(8, np.uint8))
    eight = np.zeros(len(data), np.uint64)
    for k in range(8):
        eight |= padded[k:k + len(data)].astype(np.uint64) << np.uint64(8 * k)
    common = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    at = 0
    while len(live) and at < limit:
        differ = eight[order[live] + at] ^ eight[order[live - 1] + at]
        low = differ & (~differ + np.uint64(1))
        shared = np.where(differ == 0, 8, np.floor(np.log2(np.maximum(low, 1).astype(np.float64))).astype(np.int64) // 8)
        common[live] += shared
        live = live[differ == 0]
        at += 8
    return np.minimum(common, limit)
