import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lopside.llm import substrings, suffixes
from lopside.llm.queries import QUERIES


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(st.integers(0, 2), max_size=60), st.lists(st.integers(0, 255), max_size=60)))
def test_suffix_array(values):
    text = np.array(values, np.int64)
    assert suffixes.suffix_array(text).tolist() == sorted(range(len(values)), key=lambda k: values[k:])
    assert suffixes.doubling(np.append(text + 1, 0))[1:].tolist() == sorted(range(len(values)), key=lambda k: values[k:])


def test_suffix_array_of_long_text():
    rng = random.Random(1)
    text = b"".join(rng.choice([b"the ", b"er", b"on", b"\xc3\xa9", b"aaaa", b"%%%"]) for _ in range(8000))
    order = suffixes.suffix_array(np.frombuffer(text, np.uint8))
    assert order.tolist() == sorted(range(len(text)), key=lambda k: text[k:])


def brute(rows, length=100):
    texts = sorted({((i is None, i or 0), i, (t or "").encode()) for i, t in rows})
    seen, out = set(), {}
    for _, i, t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            w = t[s:s + length]
            if w in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i, t] = (len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_against_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["th", "er", "on", "é", "a "]) for _ in range(4))
    line = lambda n: " ".join(word() for _ in range(n))
    shared = [line(30) for _ in range(6)]
    rows = []
    for k in range(120):
        parts = [line(rng.randrange(1, 30)) for _ in range(rng.randrange(4))]
        if k % 2:
            s = rng.choice(shared)
            a = rng.randrange(len(s) // 2)
            parts.insert(rng.randrange(len(parts) + 1), s[a:])
        rows.append((k, "\n".join(parts)))
    rows += [(200, None), (201, ""), (202, "x" * 99), (203, "x" * 100), (204, "y" * 5000), (None, shared[0]), (205, rows[1][1]), (3, rows[3][1]),
             (206, "ab" * 3000 + shared[1])]
    df = spark.createDataFrame([(*r, b"z", 1) for r in rows], "doc_id long, text string, kept binary, anchor int").repartition(4)
    made = substrings.dedup(df, docs_per_part=20)
    assert {"anchor", "text", "kept"} <= set(made.columns)
    got = {(r.doc_id, (r.text or "").encode()): (r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed),
                                                 hashlib.sha256(r.kept).hexdigest()) for r in made.collect()}
    assert got == brute(rows) and made.count() == len(rows)
    assert substrings.dedup(df.limit(0)).count() == 0


def test_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = {i: v for (i, _), v in brute(rows).items()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op8_suffixes"](spark, small).collect()}
    assert got == want


def test_anchors_are_spread_evenly(spark):
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 1_500_000).astype(np.uint8)
    anchor = substrings.segments(data, np.array([0, len(data)]))[2]
    rows = spark.createDataFrame([(data[:200_000].tobytes(),), (data.tobytes(),)], "_text binary").repartition(2)
    filters = substrings.repeated_anchors(rows)
    sizes = np.bincount(substrings._part(substrings.mixed(anchor), len(filters[1])), minlength=len(filters[1]))
    assert sizes.max() < 2 * sizes.mean()
    twice = np.isin(anchor, substrings.segments(data[:200_000], np.array([0, 200_000]))[2])
    passed = substrings._may_repeat(anchor, filters)
    assert passed[twice].all() and passed[~twice].mean() < 0.02
    assert [substrings.part_count(n) for n in (0, 1 << 30, 1 << 36, 1 << 60)] == [256, 256, 2048, 1 << 14]
