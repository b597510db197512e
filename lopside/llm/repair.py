"""Re-Pair: a block of token ids as a small grammar.

Frequent neighbouring pairs are replaced by new symbols (nonterminals), round after
round, until no pair is frequent enough. A packed block holds its rules, the length
that each rule expands to, and the symbols that are left, bit by bit. Pairs never
reach over the end of a piece (a document, or what of it lies in the block), so every
piece begins at a symbol of its own, and a stretch of a piece is decoded by skipping
symbols by their lengths.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

MAGIC = b"RPB1"
_HEAD = struct.Struct("<4s6Q")


@dataclass
class Grammar:
    terminals: np.ndarray  # ids of the symbols 0 .. T - 1
    left: np.ndarray  # rule k makes the symbol T + k out of left[k], right[k], both smaller
    right: np.ndarray
    symbols: np.ndarray
    first: np.ndarray  # the first symbol of each piece, and the number of symbols

    def lengths(self) -> np.ndarray:
        """How many ids each symbol stands for."""
        t = len(self.terminals)
        out = np.ones(t + len(self.left), np.int64)
        done = t
        while done < len(out):  # all rules whose parts are known, at once
            l, r = self.left[done - t:], self.right[done - t:]
            waiting = np.flatnonzero((l >= done) | (r >= done))
            upto = len(out) if not len(waiting) else done + int(waiting[0])
            out[done:upto] = out[l[:upto - done]] + out[r[:upto - done]]
            done = upto
        return out


def compress(ids: np.ndarray, starts: np.ndarray, least: int = 8, share: int = 32) -> Grammar:
    """The grammar of ``ids``; ``starts`` are the places where pieces begin, the first at 0.

    A round counts all pairs and replaces those at least a ``share``-th as frequent as the most
    frequent one, from left to right. Pairs found fewer than ``least`` times stay (on prose, rules
    for rarer pairs took more room than they saved: 9.7 bits an id at 4, 9.2 at 8).
    Empty ids: an empty grammar.
    """
    n = len(ids)
    present = np.zeros(int(ids.max(initial=0)) + 1, np.uint32)
    present[ids] = 1
    terminals = np.flatnonzero(present) if n else np.zeros(0, np.int64)
    symbols = (np.cumsum(present, dtype=np.uint32) - np.uint32(1))[ids]
    joins = np.ones(n, bool)  # whether a symbol may pair up with the next one
    ends = np.append(starts[1:], n)
    joins[ends[ends > 0] - 1] = False
    lefts, rights, size, old = [], [], len(terminals), 0
    while len(symbols) > 1:
        open_ = joins[:-1]
        if old:  # every pair of older symbols is rarer than ``least`` by now, or stays for its overlaps
            new = symbols >= old
            open_ = open_ & (new[:-1] | new[1:])
        open_ = np.flatnonzero(open_)
        shift = max(1, int(size - 1).bit_length())
        kind = np.uint32 if 2 * shift <= 32 else np.uint64
        keys = (symbols[open_].astype(kind) << kind(shift)) | symbols[open_ + 1].astype(kind)
        ordered = np.sort(keys)
        edge = np.flatnonzero(np.concatenate((np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1])))
        counts = np.diff(np.append(edge, len(ordered)))
        top = int(counts.max(initial=0))
        if top < least:
            break
        bound = max(least, top // share)
        chosen = ordered[edge[counts >= bound]]
        hit, which = _found(keys, chosen)
        at = open_[hit]
        # In a run of overlapping pairs every second one is taken, beginning with its first.
        begins = np.concatenate(([True], np.diff(at) > 1))
        run_start = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - run_start) % 2 == 0
        worth = np.bincount(which[taken], minlength=len(chosen)) >= 2
        if not worth.any():
            break
        taken &= worth[which]
        number = np.cumsum(worth) - 1
        at, which = at[taken], which[taken]
        rules = chosen[worth]
        lefts.append((rules >> kind(shift)).astype(np.int64))
        rights.append((rules & kind((1 << shift) - 1)).astype(np.int64))
        symbols[at] = size + number[which]
        joins[at] = joins[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        keep = np.flatnonzero(keep)
        symbols, joins = symbols[keep], joins[keep]
        old = size if bound == least else 0
        size += len(rules)
    none = np.zeros(0, np.int64)
    return Grammar(terminals.astype(np.uint32), np.concatenate([none, *lefts]), np.concatenate([none, *rights]),
                   symbols.astype(np.int64), np.concatenate(([0], np.flatnonzero(~joins) + 1)))


def _found(keys: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of ``keys`` that hold one of ``chosen`` (sorted), and which one."""
    own = np.arange(len(chosen), dtype=np.int32)
    slots = np.full(1 << 18, -1, np.int32)  # a small table tells of most keys by one look whether and where they are chosen
    of = _slot(chosen)
    slots[of] = own
    place = slots[_slot(keys)]
    maybe = np.flatnonzero(place >= 0)
    some, place = keys[maybe], place[maybe]
    right = chosen[place] == some
    lost = np.flatnonzero(slots[of] != own)  # those whose slot holds another one
    if len(lost):
        open_ = np.flatnonzero(~right)
        at = np.searchsorted(chosen[lost], some[open_])
        at[at == len(lost)] = 0
        place[open_] = lost[at]
        right[open_] = chosen[place[open_]] == some[open_]
    return maybe[right], place[right]


def _slot(keys: np.ndarray) -> np.ndarray:
    if keys.dtype == np.uint32:
        return (keys * np.uint32(0x9E3779B1)) >> np.uint32(14)
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.uint32)


def expand(grammar: Grammar, lengths: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The ids that ``symbols`` stand for."""
    size = lengths[symbols]
    total = int(size.sum())
    out = np.zeros(total, np.uint32)
    at, t = np.cumsum(size) - size, len(grammar.terminals)
    while len(symbols):  # level by level; every rule in use is opened once
        flat = symbols < t
        out[at[flat]] = grammar.terminals[symbols[flat]]
        at, rule = at[~flat], symbols[~flat] - t
        left, right = grammar.left[rule], grammar.right[rule]
        symbols, at = np.concatenate((left, right)), np.concatenate((at, at + lengths[left]))
    return out


def stretch(grammar: Grammar, lengths: np.ndarray, piece: int, start: int, length: int) -> np.ndarray:
    """``length`` ids of a piece from ``start`` on; only the symbols that hold them are expanded."""
    symbols = grammar.symbols[grammar.first[piece]:grammar.first[piece + 1]]
    ends = np.cumsum(lengths[symbols])
    a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, start + length, "left") + 1
    before = int(ends[a - 1]) if a else 0
    return expand(grammar, lengths, symbols[a:b])[start - before:start - before + length]


def _packed(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits (56 at most) on end, the lowest bit first."""
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :-(-width // 8)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def _unpacked(data: memoryview, count: int, width: int) -> tuple[np.ndarray, int]:
    size = -(-count * width // 8)
    padded = np.zeros(size + 8, np.uint8)
    padded[:size] = np.frombuffer(data[:size], np.uint8)
    words = np.ndarray(size + 1, "<u8", padded, strides=(1,))  # the eight bytes from every place on
    first = np.arange(count, dtype=np.int64) * width
    out = ((words[first >> 3] >> (first & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.int64)
    return out, size


def to_bytes(grammar: Grammar) -> bytes:
    """Header, terminals (32 bits each), then rules, their lengths, symbols and piece starts, each in as few bits as hold it."""
    lengths = grammar.lengths()[len(grammar.terminals):]
    width = max(1, int(len(grammar.terminals) + len(grammar.left)).bit_length())
    long = max(1, int(max(lengths.max(initial=0), len(grammar.symbols))).bit_length())
    head = _HEAD.pack(MAGIC, len(grammar.terminals), len(grammar.left), len(grammar.symbols), len(grammar.first), width, long)
    return b"".join((head, grammar.terminals.astype("<u4").tobytes(), _packed(grammar.left, width), _packed(grammar.right, width),
                     _packed(lengths, long), _packed(grammar.symbols, width), _packed(grammar.first, long)))


def from_bytes(data: bytes) -> tuple[Grammar, np.ndarray]:
    """A packed block's grammar, and the length of each symbol."""
    magic, t, rules, count, firsts, width, long = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a block of packed token ids")
    rest = memoryview(data)[_HEAD.size:]
    terminals, rest = np.frombuffer(rest[:4 * t], "<u4").astype(np.uint32), rest[4 * t:]
    parts = []
    for n, w in ((rules, width), (rules, width), (rules, long), (count, width), (firsts, long)):
        values, used = _unpacked(rest, n, w)
        parts.append(values)
        rest = rest[used:]
    left, right, lengths, symbols, first = parts
    return Grammar(terminals, left, right, symbols, first), np.concatenate((np.ones(t, np.int64), lengths))
