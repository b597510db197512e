import random
from collections import Counter

import numpy as np

from lopside.llm import dart
from lopside.llm.graph import components


def grams(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[k:k + 5]) for k in range(max(len(w) - 4, min(len(w), 1))))


def brute(rows, threshold=0.8):
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    bags = [grams(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            both, either = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
            if (rows[i][1] or "") == (rows[j][1] or "") or (either and both >= threshold * either):
                parent[root(i)] = root(j)
    out = {}
    for k, (i, _) in enumerate(rows):
        out.setdefault(root(k), []).append(i)
    return sorted(((i, min((x for x in ids if x is not None), default=None)) for ids in out.values() for i in ids), key=str)


def test_agreement_is_the_weighted_similarity():
    rng = np.random.default_rng(1)
    element = rng.integers(0, 1 << 62, 200, dtype=np.uint64)
    x, y = rng.integers(1, 9, 200).astype(float) / 2, rng.integers(1, 9, 200).astype(float) / 2
    signs = dart.signatures(np.concatenate((element, element)), np.repeat([0, 1], 200), np.concatenate((x, y)), 2, 4000)
    assert abs((signs[0] == signs[1]).mean() - np.minimum(x, y).sum() / np.maximum(x, y).sum()) < 0.03


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 60) if k % 20 != 19] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 150)]
    rng.shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: k - k % 20 for k in range(60)} | {k: 100 for k in range(100, 140)} | {150: 150, 200: 150}
    want[60] = 60 if 60 not in got else got[60]
    assert {k: got[k] for k in want if k in got} == {k: v for k, v in want.items() if k in got} and set(got) >= set(range(60))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def documents():
    rng = random.Random(4)
    rows = []
    for base in range(25):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 30, 120, 500]))]
        for copy in range(rng.choice([1, 1, 3, 8])):
            w = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                w[rng.randrange(len(w))] = f"x{rng.randrange(99)}"
            rows.append(" ".join(w))
    base = [f"z{k}" for k in range(200)]
    for k in range(90):  # one large group, every copy with an edit of its own
        w = list(base)
        w[k] = "edit"
        rows.append(" ".join(w))
    rows += ["a b", "a b", "", "", None, "   ", "tie " * 5000, "tie " * 5001]
    rng.shuffle(rows)
    return [(k, t) for k, t in enumerate(rows)] + [(None, rows[0]), (3, rows[3]), (None, "only here")]


def test_classes_against_brute_force(spark):
    rows = documents()
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, node int, class_id string").repartition(5)
    got = sorted(((r.doc_id, r.class_id) for r in dart.near_duplicates(df).collect()), key=str)
    want = brute(rows)
    assert got == want
    kept = dart.first_of_each(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({str(c) for _, c in want})
    assert dart.near_duplicates(df.limit(0)).count() == 0 and dart.first_of_each(df.limit(0)).count() == 0
