"""Counts and eigenpairs against numpy, whitening against plain sums, and odd rows."""

import numpy as np
import pytest

from lopside.llm import whitening
from lopside.llm.queries import QUERIES


def matrices():
    rng = np.random.default_rng(4)
    for size in (1, 2, 5, 30):
        a = rng.normal(size=(size, size))
        yield a @ a.T
    yield np.diag([5.0, 5, 5, 2, 2, 0, 0])
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    yield q @ np.diag([9, 9, 9, 4, 4 + 1e-9, 4 + 1e-6, 1, 1e-3, 1e-9, 0, 0, 0.5]) @ q.T
    yield np.ones((6, 6))
    yield q @ np.diag(10.0 ** -np.arange(12)) @ q.T


@pytest.mark.parametrize("a", [(m + m.T) / 2 for m in matrices()])
def test_eigenpairs_against_numpy(a):
    want = np.linalg.eigvalsh(a)[::-1]
    for shift in np.linspace(-1, want[0] * 1.1, 23) + 0.0123:
        assert whitening.Slicer(a).above(shift) == (want > shift).sum()
        assert whitening.negatives(a - shift * np.eye(len(a))) == (want < shift).sum()
    values, vectors = whitening.leading(a, 32)
    assert len(values) == (want > whitening.Slicer(a).noise).sum()
    assert np.abs(values - want[:len(values)]).max() < 1e-12 * want[0] and (np.diff(values) <= 1e-12 * want[0]).all()
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-11
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * want[0] * len(a)


def test_no_component_where_nothing_varies():
    assert len(whitening.leading(np.zeros((3, 3)), 5)[0]) == 0 and len(whitening.leading(np.zeros((0, 0)), 5)[0]) == 0
    assert len(whitening.leading(np.diag([3.0, 2, 1]), 2)[0]) == 2


def test_products_stay_exact():
    rng = np.random.default_rng(1)
    for size in (10, 1 << 20, 1 << 31, 1 << 50):
        y = rng.integers(-size, size, (40, 3))
        assert whitening.products(y).tolist() == (y.astype(object).T @ y.astype(object)).tolist()


def check(rows, got, width):
    x = np.array([[int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v] + [1_000_000] * (width - len(v))
                  for _, v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = (n * x - sums).astype(float) / n
    cov = ((n * x - sums).T @ (n * x - sums)).astype(float) / n ** 3
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(32, int((values > 1e-9 * values[0]).sum()))
    table = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-4 and abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-6
        table.setdefault(r.vec_id, {})[r.component] = r
    assert all(sorted(v) == list(range(1, k + 1)) for v in table.values())
    for (vec_id, _), d in zip(rows, deviation):
        assert table[vec_id][1].deviation == d
    w = np.array([[table[i][c].whitened for c in range(1, k + 1)] for i, _ in rows])
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    for c in range(k):
        if c and values[c - 1] - values[c] < 1e-3 * values[0] or c + 1 < len(values) and values[c] - values[c + 1] < 1e-3 * values[0]:
            continue  # close eigenvalues: the single vectors are less certain than their space
        sign = 1 if w[:, c] @ want[:, c] > 0 else -1
        assert np.abs(w[:, c] * sign - want[:, c]).max() < 1e-6
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-6


SCHEMA = "vec_id long, embedding array<float>, whitened string, n int, i int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def test_against_plain_sums(spark):
    rng = np.random.default_rng(8)
    mix = rng.normal(size=(40, 40))
    rows = [(i, [float(c) for c in rng.normal(size=40) @ mix + 3]) for i in range(500)]
    rows += [(600, [1.0, 2.0]), (601, []), (602, rows[3][1])]
    odd = [(700, None), (701, [None, 1.0]), (702, [float("nan")] * 40), (703, [float("inf"), 0.0])]
    got = whitening.component_rows(frame(spark, rows + odd).repartition(7)).collect()
    check(rows, got, 40)
    again = whitening.component_rows(frame(spark, rows[::-1]).repartition(3)).collect()
    one, other = ({(r.vec_id, r.component): r for r in x} for x in (got, again))
    assert one.keys() == other.keys() and all(one[k].deviation == other[k].deviation for k in one)
    assert all(abs(abs(one[k].whitened) - abs(other[k].whitened)) < 1e-9 for k in one)


def test_far_entries_and_tables_without_variance(spark):
    far = [(1, [1e15, 0.0]), (2, [-1e15, 0.25]), (3, [3e38, 0.5]), (4, [0.0, 0.5])]
    got = whitening.component_rows(frame(spark, far)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3, 4} and all(r.deviation is None for r in got) and got[0].identity_error < 1e-4
    for rows in ([], [(1, [2.0, 3.0])], [(1, []), (2, [])], [(1, None)], [(1, [1.0]), (2, [1.0])]):
        assert whitening.component_rows(frame(spark, rows)).count() == 0


def test_query_on_the_whole_table(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()
    check([tuple(r) for r in rows], QUERIES["op12_slicing"](spark, small).collect(), len(rows[0][1]))
