"""The curve, the bounds, and mined rows against brute force."""

import itertools

import numpy as np
import pytest

from lopside.llm import negatives
from lopside.llm.queries import QUERIES, SQL

SCHEMA = "vec_id long, embedding array<float>, label int, shard string, x int"


@pytest.mark.parametrize("dims, bits", [(1, 5), (2, 4), (3, 3), (4, 2), (5, 1)])
def test_curve_goes_through_all_cells_step_by_step(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    key = negatives.hilbert(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_are_tight():
    rng = np.random.default_rng(2)
    for size in (100, 1 << 40):
        x, block = rng.integers(-size, size, (20, 6)), rng.integers(-size, size, (50, 6))
        least, most = negatives.reach(x, block.min(axis=0)[None], block.max(axis=0)[None])
        s = negatives.scores(x, block)
        assert (s.max(axis=1) <= most[:, 0]).all() and (s.min(axis=1) >= least[:, 0]).all()
        assert s.tolist() == (x.astype(object) @ block.astype(object).T).tolist()
        one = negatives.reach(x, block[:1], block[:1])
        assert (one[0] == one[1]).all()


def brute(rows):
    sound = []
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(c is not None and np.isfinite(c) for c in v):
            sound.append((i, [int(np.floor(256 * float(np.float32(c)))) for c in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for i, q, own in {(i, tuple(q), own) for i, q, own in sound if i % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, x)), j, label) for j, x, label in sound if j != i)
        for s, j, _ in [t for t in scored if t[2] == own][:5]:
            low = [t for t in scored if t[2] != own and 30 * -s <= 100 * -t[0] <= 90 * -s][:10]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k, _) in enumerate(low)]
    return sorted(out)


def mined(spark, rows, **layout):
    df = spark.createDataFrame([(*r, "a", 3) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in negatives.mined(negatives.quantised(df), **layout).collect())


def test_against_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in rng.normal(0, 0.2, 8)], int(rng.integers(0, 4))) for i in range(0, 2400, 4)]
    rows += [(10_000 + i, rows[1][1], i % 3) for i in range(200)]  # one common vector
    rows += [(30_000 + i, [float(c) for c in rng.normal(0, 0.2, 8)], 2) for i in range(300)]  # one common label
    rows += [(5, None, 1), (6, [None, 1.0], 1), (7, [float("nan")] * 8, 1), (8, [float("inf")] * 8, 1), (9, rows[0][1], None),
             (None, rows[0][1], 1), (20_000, [0.5], 2), (20_100, [], 2), (20_001, rows[3][1], 9), (rows[25][0], *rows[25][1:]), rows[7]]
    want = brute(rows)
    assert len(want) > 500
    for layout in ({"block_rows": 16, "batch_rows": 5, "shard_values": 1000}, {"block_rows": 100, "dims": 3, "bits": 8}, {}):
        assert mined(spark, rows, **layout) == want


def test_small_and_far_tables(spark):
    assert mined(spark, []) == [] and mined(spark, [(100, [1.0], 1)]) == []
    far = [(100, [2e6, 1.0], 1), (101, [1e6, 3.0], 1), (102, [6e5, 3.0], 2), (103, [-1e6, 0.0], 2), (104, [1e30, 0.0], 2)]
    assert mined(spark, far) == brute(far) and len(brute(far)) == 1
    same = [(i, [1.0, 0.5], i % 2) for i in range(0, 300)] + [(1000 + i, [0.5, 0.5], i % 3) for i in range(50)]
    assert mined(spark, same, block_rows=20, shard_values=200) == brute(same)


def test_blocks_that_no_window_meets_are_not_read(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 1, (20, 6))
    rows = [(i, [float(c) for c in centres[i % 20] * 3 + rng.normal(0, 0.01, 6)], i % 20 // 4) for i in range(4000)]
    df = negatives.quantised(spark.createDataFrame([(*r, "a", 3) for r in rows], SCHEMA))
    made, width = negatives.blocks(df, 5, block_rows=50, dims=6, bits=6)
    table = made.collect()
    blocks, asked = [r for r in table if r.kind == 0], [r for r in table if r.kind == 1]
    assert sum(r.n for r in blocks) == 4000 and width == 6
    read = total = 0
    for a in asked:
        x, floors = negatives._matrix(a.x, a.n, width), np.frombuffer(a.floors, "<i8")
        own = [b for b in blocks if b.label == a.label]
        _, most = negatives.reach(x, np.array([b.low for b in own]), np.array([b.high for b in own]))
        read, total = read + (most >= floors[:, None]).sum(), total + a.n * len(blocks)
    assert read < total / 5


def test_against_sql(spark, small):
    from check_queries import compare, duck
    assert compare(QUERIES["op13_zones"](spark, small).toPandas(), duck(small).execute(SQL["op13_zones"]).fetchdf()) is None
