import math
import re
import zlib
from collections import Counter

import numpy as np

from lopside.llm import lattice
from lopside.llm.queries import QUERIES, vocabulary


def spell(model, word, weight):
    """The sum over all segmentations, by plain recursion."""
    value = {p: w for p, w in zip(model.pieces, weight)}
    text = b" " + word + b"\n"
    total = [1.0] + [0.0] * len(text)
    for end in range(1, len(text) + 1):
        total[end] = sum(total[s] * value.get(text[s:end], 0.0) for s in range(max(0, end - 60), end))
    return total[-1]


def test_forward_and_expected_counts():
    model = lattice.lattice(vocabulary("piece_bpe_32k.model"))
    assert abs(model.prior[model.starting].sum() - 1) < 1e-9 and abs(model.prior[~model.starting].sum() - 1) < 1e-9
    words = ["the", "erthation", "éouvielle", "x", "%%%", "東京", "the"]
    words = [w.encode() for w in words] + [b"\xff\x00z"]
    log = model.log_likelihood(words, np.log(model.prior))
    assert np.allclose(log, [math.log(spell(model, w, model.prior)) for w in words])
    n = model.expected(words, np.ones(len(words)), np.log(model.prior))
    assert np.isclose(n[model.starting].sum(), len(words)) and np.isclose(n[model.pieces.index(b"\n")], len(words))
    better = model.refined(n)
    assert model.log_likelihood(words, np.log(better)).sum() > log.sum()


def test_contract_on_a_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    tokens = {i: re.findall(rb"[^\x20\x09-\x0d]+", t.encode().lower()) + [None] for i, t in texts.items()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter(w for i, t in tokens.items() if not out[i] for w in t)
    total, v = sum(c.values()), len(c)
    rows = QUERIES["op1_lattice"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        t = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[r.doc_id], len(t), sum(c[w] > 0 for w in t), total)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (total + v + 1)) for w in t), rel_tol=1e-9)
        assert r.score < 0
    print(sum(r.score for r in rows if r.held_out), sum(r.base_score for r in rows if r.held_out))


def test_word_probabilities_and_odd_rows(spark):
    rows = [(1, "the the cat"), (2, "a\tCAT\n"), (3, None), (4, ""), (None, "the end"), (2, "a\tCAT\n"), (6, "the " * 30000), (7, "z" * 30000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int").repartition(3)
    got = {r.doc_id: r for r in lattice.score(df, vocabulary("piece_bpe_32k.model")).collect()}
    out = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    learned = [(i, (t or "").lower().split()) for i, t in rows if not out[i]]
    c = Counter(w for _, t in learned for w in t)
    n, ends = sum(c.values()) + len(learned), len(learned)
    assert got[3].n_tokens == got[4].n_tokens == 1 and got[3].score == got[4].score and got[1].train_tokens == n
    assert got[6].n_tokens == 30001 and got[6].score < got[1].score < got[3].score
    assert lattice.score(df.limit(0), vocabulary("piece_bpe_32k.model")).count() == 0
    assert ends and lattice.score(df, vocabulary("piece_bpe_32k.model")).count() == len(rows)
