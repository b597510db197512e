import numpy as np
import pyarrow as pa

from lopside.llm import packing
from lopside.llm.common import flat_bytes
from lopside.llm.queries import vocabulary


def test_white_space_at_a_texts_start(spark):
    from tokenizers import Tokenizer
    path = vocabulary("byte_bpe_50k.json")
    encode = Tokenizer.from_file(path)
    starts = ["\u00a0\u00a0", "\u00a0 ", " \u00a0", "\u00a0", "\t", "\t\t", " \t", "  ", "    ", "\u3000 ", "\r", "\u0085 ", " ", ""]
    texts = [f"{a}{b}" for a in starts for b in ("one two", "3 four", "", "été\nfive", "!\n  six", a)]
    want = [encode.encode(t, add_special_tokens=False).ids for t in texts]
    ids, counts, _ = packing.CachedEncoder(packing.byte_bpe(path))(*flat_bytes(pa.array([t.encode() for t in texts], pa.binary())))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    tokens = {r.doc_id: r.doc_tokens for r in packing.pack(docs, path).collect()}
    assert tokens == {i: len(w) + 1 for i, w in enumerate(want)}


def test_cuts_cost_least():
    rng = np.random.default_rng(11)
    for _ in range(300):
        capacity = int(rng.integers(4, 12))
        places = np.concatenate(([0], np.cumsum(rng.integers(1, capacity + 1, int(rng.integers(1, 9))))))
        penalties = rng.integers(0, 5, len(places)).astype(float)
        last = len(places) - 1

        def cost(ends):
            at = [0, *ends]
            return sum(capacity - (places[b] - places[a]) + penalties[b] for a, b in zip(at[:-1], at[1:]))

        ways = [[k + 1 for k in range(last - 1) if bits >> k & 1] + [last] for bits in range(1 << max(last - 1, 0))]
        ways = [w for w in ways if all(places[b] - places[a] <= capacity for a, b in zip([0, *w], w))]
        got = packing.cuts(places, penalties, capacity, True)
        assert got in ways and cost(got) == min(map(cost, ways))
