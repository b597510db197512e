"""Hashes do not depend on where a span lies, on the order of the spans, or on the slices."""

import numpy as np
import pyarrow as pa

from lopside.llm import common


def test_span_hashes(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(0, 4, 5000).astype(np.uint8)
    starts = rng.integers(0, 4900, 800)
    ends = starts + rng.integers(0, 90, 800)
    whole = common.span_hashes(data, starts, ends)
    grams = common.gram_hashes(data, 7)
    by_bytes = {}
    for a, b, h in zip(starts, ends, whole):
        assert by_bytes.setdefault(data[a:b].tobytes(), h) == h
    assert len(set(by_bytes.values())) == len(by_bytes)
    assert (grams[:-7] == common.span_hashes(data, np.arange(len(grams) - 7), np.arange(7, len(grams)))).all()
    monkeypatch.setattr(common, "SLICE", 64)
    assert (common.span_hashes(data, starts, ends) == whole).all() and (common.gram_hashes(data, 7) == grams).all()
    assert len(common.span_hashes(data, starts[:0], ends[:0])) == 0 and len(common.gram_hashes(data[:3], 7)) == 0


def test_shingles_of_few_words():
    """A batch of fewer words than a shingle has; the hash of a run does not depend on what stands around it."""
    from lopside.llm.common import flat_bytes, shingles
    whole = {}
    for text in (b"", b" ", b"a", b"a b", b"a b c", b"a b c d", b"a b c d e"):
        hashes, owner = shingles(*flat_bytes(pa.array([text], pa.binary())), 5)
        assert len(hashes) == len(owner) == (1 if text.split() else 0)
        whole[text] = hashes.tolist()
        if text.split():
            longer = pa.array([b"x", text + b" y z", b"z"], pa.binary())
            assert hashes[0] in shingles(*flat_bytes(longer), len(text.split()))[0]
    assert len({h for v in whole.values() for h in v}) == 5
