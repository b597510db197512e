"""A random forest with class weights per bootstrap and no bound on depth.

A row's count in a tree's bootstrap is a Poisson number drawn from a hash of (row, tree), so
the sample is the same on any partitioning. Nodes of many rows are split level by level from one
grouped histogram (tree, node, feature, bin). Nodes of few rows are each gathered in one group and
grown to their leaves there, on the exact values. All counts are integers, so sums do not
depend on their order, and neither do the trees.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Shares of a Poisson variable of mean one, cumulated (a fixed value of the distribution).
POISSON = np.cumsum(np.exp(-1.0) / np.concatenate(([1.0], np.cumprod(np.arange(1.0, 12.0)))))
TREES_AT_ONCE = 1 << 22  # nodes in one broadcast when scoring
COPY_BYTES = 64 << 20  # the largest table that is copied to every task as it is
CODED_COPIES = 4  # a coded one may be so many times larger
TASK_ROWS, MOST_ROWS = 10_000, 100_000  # of a larger table a task has so many rows, by the cores there are
GROWN = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.list_(pa.int32())), ("threshold", pa.list_(pa.float64())),
                   ("left", pa.list_(pa.int32())), ("value", pa.list_(pa.float64())), ("gains", pa.list_(pa.float64()))])
GROWN_DDL = "tree int, node int, feature array<int>, threshold array<double>, left array<int>, value array<double>, gains array<double>"


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers evenly (the finishing steps of splitmix64)."""
    x = np.asarray(x).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bootstrap(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row, named by its 64-bit key, stands in the tree's sample."""
    salt = mixed(np.array([seed * 1_000_003 + tree + 1], np.uint64))
    share = (mixed(keys.astype(np.uint64) + salt) >> np.uint64(11)).astype(float) / (1 << 53)
    return np.searchsorted(POISSON, share, "right")


def child(node: np.ndarray, side: int) -> np.ndarray:
    """The name of a node's left (1) or right (2) child; names choose the features that a node looks at."""
    return mixed(node * np.uint64(3) + np.uint64(side))


def feature_order(node: np.ndarray, features: int) -> np.ndarray:
    """For each node its features in the order in which they are tried."""
    return np.argsort(mixed(node[:, None] + np.arange(1, features + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)), axis=1, kind="stable")


def root(tree: int, seed: int) -> np.uint64:
    return mixed(np.array([seed * 7919 + tree * 2 + 1], np.uint64))[0]


def tried(order: np.ndarray, varies: np.ndarray, most: int) -> np.ndarray:
    """(nodes, features): the first ``most`` features of each node's order that vary in it."""
    seen = np.cumsum(np.take_along_axis(varies, order, axis=1), axis=1)
    out = np.zeros(varies.shape, bool)
    np.put_along_axis(out, order, np.take_along_axis(varies, order, axis=1) & (seen <= most), axis=1)
    return out


def purity(n0: np.ndarray, n1: np.ndarray, w: tuple[float, float]) -> np.ndarray:
    """Sum of squared class weights over their sum; what a split adds to it is the impurity it takes away."""
    a, b = w[0] * n0, w[1] * n1
    total = a + b
    return np.divide(a * a + b * b, total, out=np.zeros(np.shape(total)), where=total > 0)


@dataclass
class Nodes:
    """Nodes of one tree, parents before children; a leaf has no feature."""

    feature: list[np.ndarray] = field(default_factory=list)
    threshold: list[np.ndarray] = field(default_factory=list)
    left: list[np.ndarray] = field(default_factory=list)  # the right child stands next to it
    value: list[np.ndarray] = field(default_factory=list)
    gain: list[np.ndarray] = field(default_factory=list)

    def add(self, values: list[float]) -> None:
        """Leaves, one after the other."""
        for v in values:
            for column, first in zip((self.feature, self.threshold, self.left, self.value, self.gain), (-1, 0.0, -1, v, 0.0)):
                column.append(np.array([first]))

    def columns(self) -> list[np.ndarray]:
        kinds = (np.int32, np.float64, np.int32, np.float64, np.float64)
        return [np.concatenate([np.zeros(0, k), *c]).astype(k) for c, k in zip((self.feature, self.threshold, self.left, self.value, self.gain), kinds)]


@dataclass
class Coded:
    """A table whose values are replaced by their rank among the feature's distinct values, so all work on it is on small integers.

    ``bundles``: features of two values whose upper ones never stand in the same row, as the dummies of one category, share a
    column that names the one whose upper value the row has (0: none), so one count serves them all.
    """

    columns: list[np.ndarray]
    values: list[np.ndarray]
    bundles: list[tuple[list[int], np.ndarray]]

    @staticmethod
    def of(columns: list[np.ndarray], values: list[np.ndarray]) -> Coded:
        bundles: list[tuple[list[int], np.ndarray]] = []
        for f, codes in enumerate(columns):
            if len(values[f]) != 2:
                continue
            for members, shared in bundles:
                if len(members) < 255 and not (shared[codes == 1]).any():
                    break
            else:
                members, shared = [], np.zeros(len(codes), np.uint8)
                bundles.append((members, shared))
            members.append(f)
            shared[codes == 1] = len(members)
        return Coded(columns, values, [b for b in bundles if len(b[0]) > 1])

    @staticmethod
    def of_values(x: np.ndarray) -> Coded:
        pairs = [ranked(x[:, f]) for f in range(x.shape[1])]
        return Coded.of([c for c, _ in pairs], [v for _, v in pairs])


def ranked(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value's rank among the distinct ones, and these in their order."""
    if len(column):
        low, high = column.min(), column.max()
        upper = column == high
        if low < high and (upper | (column == low)).all():
            return upper.astype(np.uint8), np.array([low, high])
    values, codes = np.unique(column, return_inverse=True)
    return codes.astype(np.uint8 if len(values) <= 256 else np.int32), values


def places(starts: np.ndarray, size: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the rows of the nodes ``own`` stand, and for each of them its node's place in ``own``."""
    n = size[own]
    ends = np.cumsum(n)
    return np.repeat(starts[own] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0), np.repeat(np.arange(len(own)), n)


def grow(x: np.ndarray, y: np.ndarray, count: np.ndarray, name: np.uint64, w: tuple[float, float], leaf: int, most: int) -> list[np.ndarray]:
    """The subtree of one node on exact values; its columns as ``Nodes`` lists them."""
    return grow_coded(Coded.of_values(x), np.arange(len(y), dtype=np.int32), labelled(y, count), name, w, leaf, most)


def labelled(y: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Every row's count and, in the last bit, its class."""
    return (count.astype(np.int16) << 1) | (y == 1)


def grow_coded(table: Coded, rows: np.ndarray, label: np.ndarray, name: np.uint64, w: tuple[float, float], leaf: int, most: int) -> list[np.ndarray]:
    """``grow`` of some rows of a table, all nodes of a level at a time. ``label`` is of the whole table.

    The rows are kept in the order of their nodes; those of finished nodes are dropped. A feature of few values is counted by
    (node, value). One of many values is sorted by (node, value), only in the nodes that try it: rank, count and label stand
    in one integer, so the sorted integers hold all that the sums need.
    """
    features, few = len(table.columns), [len(v) for v in table.values]
    bundled = {f: (k, j) for k, (members, _) in enumerate(table.bundles) for j, f in enumerate(members, 1)}
    bits, shift = int(label[rows].max(initial=0)).bit_length(), len(rows).bit_length()
    starts, names, out, made = np.array([0, len(rows)]), np.array([name], np.uint64), Nodes(), 1
    while len(names):
        nodes, size = len(names), np.diff(starts)
        node, own_label = np.repeat(np.arange(nodes), size), label[rows]
        n1 = np.bincount(node, (own_label >> 1) * (own_label & 1), nodes).astype(np.int64)
        n0 = np.bincount(node, own_label >> 1, nodes).astype(np.int64) - n1
        whole = purity(n0, n1, w)
        open_ = (n0 > 0) & (n1 > 0) & (size >= 2 * leaf)
        best, cut, chosen, code = np.full(nodes, -np.inf), np.zeros(nodes), np.full(nodes, -1), np.zeros(nodes, np.int64)
        at = np.flatnonzero(open_)
        if len(at) and features:
            keep = open_[node]
            held, own_label = rows[keep], own_label[keep]
            many, sizes = len(at), size[at]
            ends = np.cumsum(sizes)
            begins = ends - sizes
            inner = np.repeat(np.arange(many), sizes)
            a0, a1 = n0[at], n1[at]
            sides = own_label & 1
            weight = (own_label >> 1).astype(float) * (1 << shift) + 1.0  # rows and counts in one sum

            def counted(codes: np.ndarray, kinds: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                """(node of ``own``, code): rows, and counts of both classes."""
                place, local = places(begins, sizes, own) if len(own) < many else (slice(None), inner)
                cell = (local * kinds + codes[held[place]]) * 2 + sides[place]
                sums = np.bincount(cell, weight[place], len(own) * kinds * 2).astype(np.int64).reshape(len(own), kinds, 2)
                return (sums & ((1 << shift) - 1)).sum(axis=2), sums[:, :, 0] >> shift, sums[:, :, 1] >> shift

            varies = np.zeros((many, features), bool)
            shared = [counted(codes, len(members) + 1, np.arange(many)) for members, codes in table.bundles]
            for f in range(features):
                if f in bundled:
                    k, j = bundled[f]
                    n = shared[k][0][:, j]
                    varies[:, f] = (n > 0) & (n < sizes)
                elif few[f] > 1:
                    codes = table.columns[f][held]
                    varies[:, f] = np.minimum.reduceat(codes, begins) < np.maximum.reduceat(codes, begins)
            use = tried(feature_order(names[at], features), varies, most)
            for f in range(features):
                own = np.flatnonzero(use[:, f])
                if not len(own):
                    continue
                values = table.values[f]
                if f in bundled:
                    k, j = bundled[f]
                    rest, r0, r1 = (s[own, j] for s in shared[k])
                    score = purity(a0[own] - r0, a1[own] - r1, w) + purity(r0, r1, w)
                    fits = (rest >= leaf) & (sizes[own] - rest >= leaf)
                    own, top = own[fits], score[fits]
                    low, high = np.zeros(len(own), np.int64), np.ones(len(own), np.int64)
                elif few[f] <= 16 or few[f] * len(own) <= 2 * sizes[own].sum():
                    n, left0, left1 = counted(table.columns[f], few[f], own)
                    there = n > 0
                    n, left0, left1 = (np.cumsum(s, axis=1) for s in (n, left0, left1))
                    score = purity(left0, left1, w) + purity(a0[own][:, None] - left0, a1[own][:, None] - left1, w)
                    rest = sizes[own][:, None] - n
                    score[~(there & (n >= leaf) & (rest >= leaf) & (rest > 0))] = -np.inf
                    low = score.argmax(axis=1)  # the first of equal ones
                    top = score[np.arange(len(own)), low]
                    fits = np.isfinite(top)
                    own, top, low, there = own[fits], top[fits], low[fits], there[fits]
                    high = (there & (np.arange(few[f]) > low[:, None])).argmax(axis=1) if len(own) else low
                else:
                    place, local = places(begins, sizes, own)
                    key = (((local << 32) | table.columns[f][held[place]]) << bits) | own_label[place]
                    key.sort()
                    value = key >> bits
                    last = np.flatnonzero(value[:-1] != value[1:])  # the last row of a node's value, if not of the table's last one
                    local = value[last] >> 32
                    n = sizes[own]
                    first = np.cumsum(n) - n
                    rank = last + 1 - first[local]
                    ok = (rank >= leaf) & (rank <= n[local] - leaf) & (rank < n[local])
                    last, local = last[ok], local[ok]
                    if not len(last):
                        continue
                    amount = (key & ((1 << bits) - 1)) >> 1
                    every, ones = np.cumsum(amount), np.cumsum(amount * (key & 1))
                    before = np.concatenate(([0], every))[first], np.concatenate(([0], ones))[first]
                    left1 = ones[last] - before[1][local]
                    left0 = every[last] - before[0][local] - left1
                    score = purity(left0, left1, w) + purity(a0[own][local] - left0, a1[own][local] - left1, w)
                    edge = np.flatnonzero(np.concatenate(([True], local[1:] != local[:-1])))
                    top = np.maximum.reduceat(score, edge)
                    is_top = np.flatnonzero(score == np.repeat(top, np.diff(np.append(edge, len(local)))))
                    pick = is_top[np.concatenate(([True], local[is_top][1:] != local[is_top][:-1]))]  # the first of equal ones
                    own = own[local[pick]]
                    low, high = (value[last[pick] + k] & 0xFFFFFFFF for k in (0, 1))
                better = top > best[at[own]]
                own, top, low, high = at[own[better]], top[better], values[low[better]], (values[high[better]], low[better])
                middle = (low + high[0]) / 2
                cut[own] = np.where((middle < high[0]) & np.isfinite(middle), middle, low)
                chosen[own], best[own], code[own] = f, top, high[1]
        split = chosen >= 0
        kids = np.cumsum(split) - 1
        out.feature.append(chosen)
        out.threshold.append(cut)
        out.left.append(np.where(split, made + 2 * kids, -1))
        out.value.append(w[1] * n1 / (w[0] * n0 + w[1] * n1))
        out.gain.append(np.where(split, best - whole, 0.0))
        made += 2 * int(split.sum())
        if not split.any():
            break
        rows = rows[split[node]]
        size, chosen, code = size[split], chosen[split], code[split]
        ends = np.cumsum(size)
        begins = ends - size
        side = np.empty(len(rows), bool)
        for f in np.unique(chosen):
            own = np.flatnonzero(chosen == f)
            place, local = places(begins, size, own)
            side[place] = table.columns[f][rows[place]] > code[own][local]
        rights = np.cumsum(side)
        before = np.concatenate(([0], rights))[begins]
        right = rights[ends - 1] - before
        # each node's rows: those of its left child, then those of its right one, in their order
        here = rights - np.repeat(before, size)  # rights of the node so far
        first = np.repeat(begins, size)
        moved = np.empty_like(rows)
        moved[np.where(side, first + np.repeat(size - right, size) + here - 1, np.arange(len(rows)) - here)] = rows
        rows = moved
        sizes = np.stack((size - right, right), 1).ravel()
        starts = np.concatenate(([0], np.cumsum(sizes)))
        names = np.stack((child(names[split], 1), child(names[split], 2)), 1).ravel()
    return out.columns()


def histogram_split(counts: np.ndarray, name: np.uint64, w: tuple[float, float], leaf: int, most: int) -> tuple[int, int, float]:
    """(feature, bin, score) of the best cut of ``counts`` (feature, bin, (rows, zeros, ones)); feature -1 if there is none."""
    varies = (counts[:, :, 0] > 0).sum(axis=1) > 1
    use = tried(feature_order(np.array([name], np.uint64), len(counts)), varies[None], most)[0]
    left = np.cumsum(counts, axis=1)[:, :-1]
    right = counts.sum(axis=1, keepdims=True) - left
    score = purity(left[:, :, 1], left[:, :, 2], w) + purity(right[:, :, 1], right[:, :, 2], w)
    score[~use] = -np.inf
    score[(left[:, :, 0] < max(leaf, 1)) | (right[:, :, 0] < max(leaf, 1))] = -np.inf
    f, b = np.unravel_index(int(score.argmax()), score.shape) if score.size else (0, 0)
    return (int(f), int(b), float(score[f, b])) if score.size and np.isfinite(score[f, b]) else (-1, 0, 0.0)


def whole_tree(table: Coded, label: np.ndarray, name: np.uint64, w: tuple[float, float], leaf: int, most: int, node_rows: int,
               cuts: list[np.ndarray], bins: int) -> tuple[list[np.ndarray], np.ndarray]:
    """One tree of a coded table, and what its splits gained by feature: large nodes on the cut points, small ones on the exact values."""
    features = len(table.columns)
    own = np.flatnonzero(label > 1).astype(np.int32)
    if not len(own):
        return [*Nodes([np.array([-1])], [np.zeros(1)], [np.array([-1])], [np.zeros(1)]).columns()[:4]], np.zeros(features)
    if len(own) <= node_rows:
        columns = grow_coded(table, own, label, name, w, leaf, most)
        return columns[:4], gains_of(columns, features)
    bin_of = [np.searchsorted(c, v, "left") for c, v in zip(cuts, table.values)]
    tree, small, large = Nodes(), [], [(0, own, name)]
    tree.add([0.0])
    while large:
        deeper = []
        for place, rows, name in large:
            held, varying = np.zeros((features, bins, 3), np.int64), 0
            here = label[rows]
            amount, ones = here >> 1, (here >> 1) * (here & 1)
            for f in feature_order(np.array([name], np.uint64), features)[0]:
                if varying == most:  # no further feature is tried
                    break
                b = bin_of[f][table.columns[f][rows]]
                held[f, :, 0], held[f, :, 1], held[f, :, 2] = np.bincount(b, None, bins), np.bincount(b, amount, bins), np.bincount(b, ones, bins)
                varying += int((held[f, :, 0] > 0).sum() > 1)
            held[:, :, 1] -= held[:, :, 2]
            f, b, score = histogram_split(held, name, w, leaf, most)
            if f < 0:  # nothing to tell the rows apart at these cuts: to be finished with all values
                small.append((place, rows, name))
                continue
            gain, left, right, values = split_sums(held[f], b, score, w)
            at = len(tree.feature)
            tree.feature[place], tree.threshold[place], tree.left[place], tree.gain[place] = (np.array([v]) for v in (f, cuts[f][b], at, gain))
            tree.add(values)
            far = bin_of[f][table.columns[f][rows]] > b
            for side, sums in enumerate((left, right)):
                if sums[1] and sums[2]:
                    node = (at + side, rows[far == bool(side)], child(np.array([name], np.uint64), side + 1)[0])
                    (deeper if sums[0] > node_rows else small).append(node)
        large = deeper
    columns = tree.columns()
    gained, columns = gains_of(columns, features), columns[:4]
    for place, rows, name in small:
        part = grow_coded(table, rows, label, name, w, leaf, most)
        columns, gained = _grafted(columns, place, part[:4]), gained + gains_of(part, features)
    return columns, gained


def split_sums(held: np.ndarray, b: int, score: float, w: tuple[float, float]) -> tuple[float, np.ndarray, np.ndarray, list[float]]:
    """(gain, sums left and right of the cut, values of both children) of a feature's counts (bin, (rows, zeros, ones))."""
    left, every = held[:b + 1].sum(axis=0), held.sum(axis=0)
    right = every - left
    value = [float(w[1] * s[2] / max(w[0] * s[1] + w[1] * s[2], 1e-300)) for s in (left, right)]
    return score - float(purity(every[1], every[2], w)), left, right, value


def descend(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf that each row of ``x`` comes to."""
    node = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while len(rows):
        at = node[rows]
        rows = rows[feature[at] >= 0]
        at = node[rows]
        node[rows] = left[at] + (x[rows, feature[at]] > threshold[at])
    return node


def packed(feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, value: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(steps, threshold, value) of a tree for ``leaf_values``: a step holds the left child and the feature; a leaf leads to itself."""
    leaf = feature < 0
    steps = (np.where(leaf, np.arange(len(feature)), left).astype(np.int64) << width.bit_length()) | np.where(leaf, 0, feature)
    return steps, np.where(leaf, np.inf, threshold), value


def leaf_values(columns: np.ndarray, rows: int, width: int, steps: np.ndarray, threshold: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The value of the leaf that each row comes to; ``columns`` holds the rows' features one after the other.

    Rows that are in their leaf are taken out only now and then: staying there costs less.
    """
    bits = width.bit_length()
    out, row, node = np.empty(rows), np.arange(rows), np.zeros(rows, np.int64)
    while len(row):
        for _ in range(6):
            step, before = steps.take(node), node
            at = step & ((1 << bits) - 1)
            at *= rows
            at += row
            node = step >> bits
            node += columns.take(at) > threshold.take(before)
        there = node == before
        out[row[there]] = value[node[there]]
        row, node = row[~there], node[~there]
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(float)


def gains_of(columns: list[np.ndarray], width: int) -> np.ndarray:
    """What the splits of ``columns`` gained, by feature."""
    inner = columns[0] >= 0
    return np.bincount(columns[0][inner], columns[4][inner], width)


def grown_row(tree: int, node: int, columns: list[np.ndarray], width: int) -> pa.RecordBatch:
    values = (tree, node, *columns[:4], gains_of(columns, width))
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, GROWN.types)], schema=GROWN)


def arrays_of(rows: DataFrame, lists: list[str], *keys: str) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """(keys, arrays) of rows that hold lists, as Arrow sends them: a list of Python numbers takes several times the memory."""
    for batch in rows.select(*keys, *lists).toArrow().to_batches():
        for row in range(batch.num_rows):
            yield tuple(batch[k][row].as_py() for k in keys), [batch[c][row].values.to_numpy(zero_copy_only=False) for c in lists]


class _Fit:
    """One forest in the making: ``rows`` hold key (long), x (array<double>) and y (0 or 1)."""

    def __init__(self, rows: DataFrame, trees: int, leaf: int, most: int, seed: int, balanced: bool, node_rows: int, bins: int, sample: int):
        self.rows, self.trees, self.leaf, self.seed, self.balanced = rows, trees, leaf, seed, balanced
        self.node_rows, self.bins, self.sample = node_rows, bins, sample
        self.width = rows.select(F.size("x").alias("n")).head()["n"]
        self.most = most or max(1, int(self.width ** 0.5))
        self.partial = [Nodes() for _ in range(trees)]  # built from histograms; small nodes are leaves so far

    def class_weights(self) -> tuple[list[tuple[float, float]], list[int]]:
        """Each tree's weights of class 0 and 1, balanced in its own bootstrap, and its rows."""
        trees, seed = self.trees, self.seed

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((trees, 3), np.int64)
            for batch in batches:
                key, y = batch.column("key").to_numpy().view(np.uint64), batch.column("y").to_numpy()
                for t in range(trees):
                    count = bootstrap(key, t, seed)
                    total[t] += (count > 0).sum(), count[y == 0].sum(), count[y == 1].sum()
            yield pa.RecordBatch.from_pydict({"tree": pa.array(np.arange(trees), pa.int32()), "n": total[:, 0], "n0": total[:, 1], "n1": total[:, 2]})

        found = (self.rows.select("key", "y").mapInArrow(run, "tree int, n long, n0 long, n1 long").groupBy("tree")
                 .agg(F.sum("n").alias("n"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).orderBy("tree").collect())
        return [self._weights(r.n0, r.n1) for r in found], [r.n for r in found]

    @property
    def _weights(self):
        balanced = self.balanced

        def of(n0: int, n1: int) -> tuple[float, float]:
            total = n0 + n1
            return (total / (2 * n0) if n0 else 1.0, total / (2 * n1) if n1 else 1.0) if balanced else (1.0, 1.0)

        return of

    def cut_points(self) -> list[np.ndarray]:
        """Thresholds that large nodes may use, from at most ``sample`` rows, those least by their key."""
        # A sort with a limit sends that many rows of every part to the driver, so most rows are left out before, by their hashed key.
        few, share = self.rows, 1.25 * self.sample / max(1, self.rows.count())
        while share < 1:
            few = self.rows.filter(F.col("key") <= int(share * (1 << 64)) - (1 << 63))
            if few.count() >= self.sample:
                break
            few, share = self.rows, 4 * share
        held = np.array([r.x for r in few.orderBy("key").limit(self.sample).select("x").collect()])
        out = []
        for f in range(self.width):
            values = np.unique(held[:, f])
            middles = (values[:-1] + values[1:]) / 2
            some = np.unique(np.linspace(0, len(middles) - 1, min(self.bins - 1, len(middles))).astype(int)) if len(middles) else []
            out.append(middles[some] if len(middles) else np.zeros(0))
        return out

    def split_large(self, weights: list, sizes: list[int]) -> list[list[tuple[int, np.uint64]]]:
        """Split nodes of more than ``node_rows`` rows, level by level; gives each tree's small nodes (place, name)."""
        small: list[list] = [[] for _ in range(self.trees)]
        large = []
        for t in range(self.trees):
            self.partial[t].add([0.0])
            (large if sizes[t] > self.node_rows else small[t]).append((t, 0, root(t, self.seed)) if sizes[t] > self.node_rows else (0, root(t, self.seed)))
        cuts = self.cut_points() if large else []
        while large:
            found = {(r.tree, r.node): r for r in self._histograms(large, cuts, weights)}
            deeper = []
            for t, place, name in large:
                r = found[t, place]
                tree = self.partial[t]
                if r.feature < 0:  # nothing to tell the rows apart at these cuts: to be finished with all values
                    small[t].append((place, name))
                    continue
                at = len(tree.feature)
                tree.feature[place], tree.threshold[place] = np.array([r.feature]), np.array([cuts[r.feature][r.bin]])
                tree.left[place], tree.gain[place] = np.array([at]), np.array([r.gain])
                tree.add([r.left_value, r.right_value])
                for side, rows, pure in ((0, r.left_rows, r.left_pure), (1, r.right_rows, r.right_pure)):
                    here = (at + side, child(np.array([name], np.uint64), side + 1)[0])
                    if not pure:
                        if rows > self.node_rows:
                            deeper.append((t, *here))
                        else:
                            small[t].append(here)
            large = deeper
        return small

    def _histograms(self, large: list, cuts: list[np.ndarray], weights: list) -> list:
        """Each large node's best cut, from counts summed over all rows."""
        trees = {t: self.partial[t].columns()[:3] for t, *_ in large}
        wanted = {t: {p: n for u, p, n in large if u == t} for t in trees}
        width, bins, seed, leaf, most = self.width, self.bins, self.seed, self.leaf, self.most

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                x, y, key = _matrix(batch.column("x"), width), batch.column("y").to_numpy(), batch.column("key").to_numpy().view(np.uint64)
                bin_of = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
                for t, tree in trees.items():
                    c = bootstrap(key, t, seed)
                    node = descend(x, *tree)
                    for p in wanted[t]:
                        own = np.flatnonzero((node == p) & (c > 0))
                        held = total.setdefault((t, p), np.zeros((width, bins, 3), np.int64))
                        for f in range(width):
                            for k, amount in enumerate((None, c[own] * (y[own] == 0), c[own] * (y[own] == 1))):
                                held[f, :, k] += np.bincount(bin_of[own, f], amount, bins).astype(np.int64)
            for (t, p), held in total.items():
                f, b = np.nonzero(held[:, :, 0])
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array(np.full(len(f), t, np.int32)), "node": pa.array(np.full(len(f), p, np.int32)), "f": pa.array(f, pa.int32()),
                    "b": pa.array(b, pa.int32()), "n": held[f, b, 0], "n0": held[f, b, 1], "n1": held[f, b, 2]})

        summed = (self.rows.mapInArrow(count, "tree int, node int, f int, b int, n long, n0 long, n1 long").groupBy("tree", "node", "f", "b")
                  .agg(*[F.sum(c).alias(c) for c in ("n", "n0", "n1")]))
        listed = summed.groupBy("tree", "node").agg(F.collect_list(F.struct("f", "b", "n", "n0", "n1")).alias("cells"))  # features x bins at most

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for t, p, cells in zip(*(c.to_pylist() for c in batch.columns)):
                    held = np.zeros((width, bins, 3), np.int64)
                    for c in cells:
                        held[c["f"], c["b"]] = c["n"], c["n0"], c["n1"]
                    f, b, score = histogram_split(held, wanted[t][p], weights[t], leaf, most)
                    gain, left, right, value = split_sums(held[f], b, score, weights[t])
                    yield pa.RecordBatch.from_pylist([{
                        "tree": t, "node": p, "feature": f, "bin": b, "gain": gain, "left_rows": int(left[0]),
                        "right_rows": int(right[0]), "left_value": value[0], "right_value": value[1],
                        "left_pure": not (left[1] and left[2]), "right_pure": not (right[1] and right[2])}], schema)

        schema = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()), ("gain", pa.float64()),
                            ("left_rows", pa.int64()), ("right_rows", pa.int64()), ("left_value", pa.float64()), ("right_value", pa.float64()),
                            ("left_pure", pa.bool_()), ("right_pure", pa.bool_())])
        return listed.mapInArrow(best, "tree int, node int, feature int, bin int, gain double, left_rows long, right_rows long, "
                                       "left_value double, right_value double, left_pure boolean, right_pure boolean").collect()

    def finish_small(self, weights: list, small: list[list]) -> DataFrame:
        """(tree, node, feature, threshold, left, value, gain): the subtree of every small node, grown in one group."""
        trees = [self.partial[t].columns()[:3] for t in range(self.trees)]
        names = [dict(s) for s in small]
        width, seed, leaf, most = self.width, self.seed, self.leaf, self.most

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y, key = _matrix(batch.column("x"), width), batch.column("y").to_numpy().astype(np.int8), batch.column("key").to_numpy().view(np.uint64)
                out = []
                for t, tree in enumerate(trees):
                    c = bootstrap(key, t, seed)
                    node = descend(x, *tree) if len(tree[0]) > 1 else np.zeros(len(x), np.int64)
                    drawn = np.flatnonzero(c > 0)
                    order = drawn[np.argsort(node[drawn], kind="stable")]
                    edges = np.flatnonzero(np.concatenate(([True], np.diff(node[order]) > 0))) if len(order) else []
                    for rows in np.split(order, edges[1:]) if len(order) else ():
                        place = int(node[rows[0]])
                        if place in names[t]:
                            out.append((t, place, x[rows].tobytes(), y[rows].tobytes(), c[rows].astype(np.int8).tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                                                     ["tree", "node", "x", "y", "c"])

        def finish(key: tuple, held: list) -> pa.RecordBatch:
            x = np.frombuffer(b"".join(h[0] for h in held)).reshape(-1, width)
            y, c = (np.frombuffer(b"".join(h[k] for h in held), np.int8) for k in (1, 2))
            return grown_row(*key, grow(x, y, c, names[key[0]][key[1]], weights[key[0]], leaf, most), width)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, held = None, []
            for batch in batches:
                for t, p, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                    if (t, p) != key and held:
                        yield finish(key, held)
                        held = []
                    key = (t, p)
                    held.append(parts)
            if held:
                yield finish(key, held)

        groups = sum(map(len, small))
        dealt = self.rows.mapInArrow(deal, "tree int, node int, x binary, y binary, c binary")
        return (dealt.repartition(max(1, min(groups, 4096)), "tree", "node").sortWithinPartitions("tree", "node")
                .mapInArrow(run, GROWN_DDL))

    def small_copy(self) -> tuple[Coded, np.ndarray, np.ndarray]:
        """(coded table, y, key) of few rows."""
        held = self.rows.select("key", "x", "y").toArrow().combine_chunks()
        x = _matrix(held["x"].combine_chunks() if held["x"].num_chunks != 1 else held["x"].chunk(0), self.width)
        return Coded.of_values(x), held["y"].to_numpy().astype(np.int8), held["key"].to_numpy().view(np.uint64)

    def short_lists(self) -> list[np.ndarray | None]:
        """The distinct values of each feature, where there are at most 256."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: list = [np.zeros(0)] * width
            for batch in batches:
                x = _matrix(batch.column("x"), width)
                for f in range(width):
                    if found[f] is not None:
                        found[f] = np.unique(np.concatenate((found[f], x[:, f])))
                        found[f] = found[f] if len(found[f]) <= 256 else None
            yield pa.RecordBatch.from_pydict({"f": pa.array(range(width), pa.int32()), "v": pa.array(found, pa.list_(pa.float64()))})

        out: list = [np.zeros(0)] * width
        for f, values in self.rows.select("x").mapInArrow(run, "f int, v array<double>").collect():
            if out[f] is not None:
                out[f] = None if values is None else np.union1d(out[f], values)
                out[f] = out[f] if out[f] is None or len(out[f]) <= 256 else None
        return out

    def coded_copy(self, rows: int) -> tuple[Coded, np.ndarray, np.ndarray] | None:
        """(coded table, y, key), or nothing if that takes more than CODED_COPIES times COPY_BYTES; features of few values take a byte."""
        lists, width = self.short_lists(), self.width
        short, long = ([f for f in range(width) if (lists[f] is None) == wide] for wide in (False, True))
        if rows * (9 + len(short) + 8 * len(long)) > CODED_COPIES * COPY_BYTES:
            return None

        def collected(make, kinds: list) -> list[np.ndarray]:
            """One array of each kind from what ``make`` finds in a batch, all rows in the same order."""
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    yield pa.RecordBatch.from_pydict({"b": pa.array([[v.tobytes() for v in make(batch)]], pa.list_(pa.binary()))})

            held = self.rows.select("key", "x", "y").mapInArrow(run, "b array<binary>").toArrow()["b"]
            return [np.frombuffer(b"".join(v.values[k].as_buffer() for v in held), kind) for k, kind in enumerate(kinds)]

        def small_parts(batch: pa.RecordBatch) -> list[np.ndarray]:
            x = _matrix(batch.column("x"), width)
            codes = [np.searchsorted(lists[f], x[:, f]).astype(np.uint8) for f in short]
            return [batch.column("key").to_numpy(), batch.column("y").to_numpy().astype(np.int8), *codes]

        key, y, *codes = collected(small_parts, [np.uint64, np.int8, *[np.uint8] * len(short)])
        columns, values = [np.zeros(0)] * width, [np.zeros(0)] * width
        for f, column in zip(short, codes):
            columns[f], values[f] = column, lists[f]
        for f in long:  # one after the other, so the driver holds the values of one
            columns[f], values[f] = ranked(collected(lambda batch, f=f: [_matrix(batch.column("x"), width)[:, f]], [np.float64])[0])
        return Coded.of(columns, values), y, key

    def grown_from_a_copy(self, table: Coded, y: np.ndarray, key: np.ndarray, cuts: list[np.ndarray]) -> dict[int, list[np.ndarray]]:
        """All trees of a table that every task can hold: one broadcast copy of it, a tree grown in one task, nothing shuffled."""
        spark = self.rows.sparkSession
        shared = spark.sparkContext.broadcast((table, y, key))
        seed, leaf, most, weights_of, node_rows, bins = self.seed, self.leaf, self.most, self._weights, self.node_rows, self.bins

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, y, key = shared.value
            for batch in batches:
                for t in batch.column("id").to_pylist():
                    label = np.concatenate([labelled(y[i:i + 65_536], bootstrap(key[i:i + 65_536], t, seed)) for i in range(0, len(y), 65_536)])
                    n, n1 = int((label >> 1).sum(dtype=np.int64)), int(((label >> 1) * (label & 1)).sum(dtype=np.int64))
                    columns, gained = whole_tree(table, label, root(t, seed), weights_of(n - n1, n1), leaf, most, node_rows, cuts, bins)
                    values = (t, 0, *columns, gained)
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, GROWN.types)], schema=GROWN)

        tasks = max(1, min(self.trees, max(spark.sparkContext.defaultParallelism * 4, self.trees * (len(y) > self.node_rows))))
        try:
            return {t: columns for (t,), columns in arrays_of(spark.range(0, self.trees, 1, tasks).mapInArrow(run, GROWN_DDL), GROWN.names[2:], "tree")}
        finally:
            shared.destroy()

    def dealt(self, rows: int) -> DataFrame:
        """The rows in parts of even size, enough for all cores: a table may come in a few files, or in one, and every
        level passes over all rows for all trees. The counts are integers, so the trees do not depend on the parts."""
        cores = self.rows.sparkSession.sparkContext.defaultParallelism
        return self.rows.repartition(max(-(-rows // MOST_ROWS), min(cores, -(-rows // TASK_ROWS))))

    def run(self) -> tuple[list[list[np.ndarray]], np.ndarray]:
        rows = self.rows.count()
        if rows <= self.node_rows and rows * (self.width + 2) * 8 <= COPY_BYTES:
            return self._whole(self.grown_from_a_copy(*self.small_copy(), []))
        self.rows = self.dealt(rows).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            weights, sizes = self.class_weights()
            copy = self.coded_copy(rows)
            if copy is not None:
                cuts = self.cut_points() if max(sizes) > self.node_rows else []
                self.rows.unpersist()  # the tasks need their memory for the copy
                return self._whole(self.grown_from_a_copy(*copy, cuts))
            small = self.split_large(weights, sizes)
            grown: dict[tuple[int, int], list[np.ndarray]] = {}
            if any(small):
                grown = dict(arrays_of(self.finish_small(weights, small), GROWN.names[2:], "tree", "node"))
        finally:
            self.rows.unpersist()
        whole, gains = [], []
        for t in range(self.trees):
            columns = self.partial[t].columns()
            gained, columns = gains_of(columns, self.width), columns[:4]
            for place, _ in small[t]:
                if (t, place) in grown:
                    *part, more = grown.pop((t, place))
                    columns, gained = _grafted(columns, place, part), gained + more
            whole.append(columns)
            gains.append(gained)
        return self._forest(whole, gains)

    def _whole(self, grown: dict[int, list[np.ndarray]]) -> tuple[list[list[np.ndarray]], np.ndarray]:
        return self._forest([grown[t][:4] for t in range(self.trees)], [grown[t][4] for t in range(self.trees)])

    def _forest(self, trees: list[list[np.ndarray]], gains: list[np.ndarray]) -> tuple[list[list[np.ndarray]], np.ndarray]:
        """The trees, and the share of the gains that each feature has, meaned over the trees."""
        importance = np.zeros(self.width)
        for own in gains:
            importance += own / own.sum() if own.sum() > 0 else 0
        total = importance.sum()
        return trees, importance / total if total > 0 else importance


def _grafted(tree: list[np.ndarray], place: int, part: list[np.ndarray]) -> list[np.ndarray]:
    """A subtree put in the place of a leaf: its root there, its other nodes at the end."""
    shift = len(tree[0]) - 1
    part = [*part[:2], np.where(part[2] >= 0, part[2] + shift, -1), *part[3:]]
    out = []
    for whole, own in zip(tree, part):
        whole = whole.copy()
        whole[place] = own[0]
        out.append(np.concatenate((whole, own[1:])))
    return out


class BootstrapForest(Estimator):
    """Random forest of two classes: Gini, square root of the features at a node, no bound on depth.

    ``balanced``: class weights n / (2 n_c), taken in each tree's bootstrap. ``leaf``: the least rows of a leaf, repeated draws
    counted once. Nodes of more than ``node_rows`` rows use ``bins`` cut points, found in at most ``sample`` rows.
    Rows without a label or a key are left out; equal keys are drawn together.
    """

    def __init__(self, trees: int = 150, leaf: int = 5, balanced: bool = False, seed: int = 42, features_at_node: int | None = None,
                 node_rows: int = 200_000, bins: int = 256, sample: int = 65_536, label: str = "_y", key: str = "_key"):
        super().__init__()
        self.trees, self.leaf, self.balanced, self.seed, self.most = trees, leaf, balanced, seed, features_at_node
        self.node_rows, self.bins, self.sample, self.label, self.key = node_rows, bins, sample, label, key

    def _fit(self, df: DataFrame) -> ForestModel:
        rows = df.select(F.xxhash64(self.key).alias("key"), vector_to_array("features").alias("x"), F.col(self.label).cast("int").alias("y")).dropna()
        if rows.isEmpty():
            raise ValueError("a forest needs rows with a label")
        forest, importance = _Fit(rows, self.trees, self.leaf, self.most, self.seed, self.balanced, self.node_rows, self.bins, self.sample).run()
        return ForestModel.of(forest, importance)


class ForestModel(Model, MLReadable, MLWritable):
    """Adds ``probability`` (of both classes, the mean over the trees' leaves) and ``prediction``."""

    spec = Param(Params._dummy(), "spec", "settings as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, spec: str = "{}"):
        super().__init__()
        self._set(spec=spec)
        self.forest: list[list[np.ndarray]] = []

    @staticmethod
    def of(forest: list[list[np.ndarray]], importance: np.ndarray) -> ForestModel:
        model = ForestModel(spec=json.dumps({"importance": [float(v) for v in importance]}))
        model.forest = forest
        return model

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(json.loads(self.getOrDefault(self.spec))["importance"])

    def _transform(self, df: DataFrame) -> DataFrame:
        width, trees = len(self.featureImportances), len(self.forest)
        out = df.withColumn("_forest_x", vector_to_array("features")).withColumn("_forest_sum", F.lit(0.0))
        for group in self._groups():
            shared = df.sparkSession.sparkContext.broadcast([packed(*tree, width) for tree in group])  # at most TREES_AT_ONCE nodes, or one tree

            @F.pandas_udf("double")
            def add(x, before):
                m = np.array(x.tolist(), float).reshape(len(x), width).T.ravel()
                total = before.to_numpy(float, copy=True)
                for tree in shared.value:
                    total += leaf_values(m, len(x), width, *tree)
                return before.__class__(total)

            out = out.withColumn("_forest_sum", add("_forest_x", "_forest_sum"))
        p = F.col("_forest_sum") / trees
        return (out.withColumn("_forest_sum", p)
                .withColumn("probability", array_to_vector(F.array(1 - F.col("_forest_sum"), F.col("_forest_sum"))))
                .withColumn("rawPrediction", F.col("probability"))
                .withColumn("prediction", (F.col("_forest_sum") > 0.5).cast("double")).drop("_forest_x", "_forest_sum"))

    def _groups(self) -> list[list[list[np.ndarray]]]:
        groups: list[list] = []
        held = TREES_AT_ONCE + 1
        for tree in self.forest:
            if held + len(tree[0]) > TREES_AT_ONCE:
                groups.append([])
                held = 0
            groups[-1].append(tree)
            held += len(tree[0])
        return groups

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        forest = self.model.forest
        columns = [pa.array([tree[k] for tree in forest], pa.list_(t)) for k, t in enumerate((pa.int32(), pa.float64(), pa.int32(), pa.float64()))]
        table = pa.table([pa.array(range(len(forest)), pa.int32()), *columns], names=["tree", "feature", "threshold", "left", "value"])
        spark.createDataFrame(table).repartition(max(1, len(forest) // 16)).write.mode("overwrite").parquet(f"{path}/trees")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = ForestModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        rows = arrays_of(spark.read.parquet(f"{path}/trees"), GROWN.names[2:6], "tree")
        model.forest = [columns for _, columns in sorted(rows, key=lambda r: r[0])]
        return model
