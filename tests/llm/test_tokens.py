"""Grammars that give their ids back, ids equal to the library's, and files that can be read at random."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lopside.llm import repair, tokens
from lopside.llm.common import flat_bytes
from lopside.llm.queries import QUERIES, vocabulary

ODD = ["It's 12's a'll <|endoftext|>x<|EndOfText|> foo<|startoftext|>b", "éa≠b ≮ 1́ Å", "", " ",
       "\n  x y", "naïve 東京 ½ ² x²3a_b--c'sd'S 'RE ..'s,'s 's", "Σας ΟΔΟΣ İstanbul ÀÉß", "a\x00b\x1cc\x85d​x",
       "😀😀a1😀 1,2.3e-5", "x" * 300, "a \x1cword \x85Über", "no break   spaces"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=1, max_size=60), min_size=1, max_size=8), st.integers(2, 4))
def test_grammar_gives_the_ids_back(pieces, least):
    sizes = np.array([len(x) for x in pieces])
    ids, starts = np.array([i for x in pieces for i in x], np.uint32) * 9000, np.cumsum(sizes) - sizes
    grammar, lengths = repair.from_bytes(repair.to_bytes(repair.compress(ids, starts, least)))
    assert repair.expand(grammar, lengths, grammar.symbols).tolist() == ids.tolist()
    assert (grammar.lengths() == lengths).all() and len(grammar.first) == len(pieces) + 1
    used = np.bincount(np.concatenate((grammar.left, grammar.right, grammar.symbols)), minlength=len(lengths))
    assert used.all()
    for k in range(len(pieces)):
        own = grammar.symbols[grammar.first[k]:grammar.first[k + 1]]
        assert repair.expand(grammar, lengths, own).tolist() == ids[starts[k]:starts[k] + sizes[k]].tolist()
        for a in range(0, sizes[k], 7):
            n = min(5, int(sizes[k]) - a)
            assert repair.stretch(grammar, lengths, k, a, n).tolist() == ids[starts[k] + a:starts[k] + a + n].tolist()


def test_repeats_become_few_symbols():
    ids = np.tile(np.arange(1000, dtype=np.uint32), 64)
    grammar = repair.compress(ids, np.array([0]), least=4)
    assert len(grammar.symbols) <= 4 and len(repair.to_bytes(grammar)) < ids.nbytes / 20
    pairs = np.random.default_rng(5).integers(0, 50, 4000)
    pairs = np.stack((pairs, pairs + 100), 1).ravel()
    assert len(repair.compress(pairs, np.array([0])).symbols) <= 4000
    same = repair.compress(np.zeros(1 << 16, np.uint32), np.array([0]), least=4)
    assert len(same.symbols) + len(same.left) < 40
    assert len(repair.compress(np.zeros(0, np.uint32), np.zeros(0, np.int64)).symbols) == 0


def test_later_rounds_look_at_new_symbols_alone(monkeypatch):
    once = np.arange(10, 5010)
    often = np.tile([1, 2, 3], (20, 1))  # 1 2 is taken everywhere, so 2 3, found as often, nowhere
    ids = np.concatenate([once, *(np.append(x, 6000 + k) for k, x in enumerate(often))]).astype(np.uint32)
    looked, found = [], repair._found
    monkeypatch.setattr(repair, "_found", lambda keys, chosen: looked.append(len(keys)) or found(keys, chosen))
    grammar = repair.compress(ids, np.array([0]))
    assert looked[0] == len(ids) - 1 and len(looked) > 1 and max(looked[1:]) <= 60
    assert repair.expand(grammar, grammar.lengths(), grammar.symbols).tolist() == ids.tolist()


def test_pairs_are_found_where_they_share_a_slot(monkeypatch):
    keys = np.random.default_rng(3).integers(0, 500, 4000).astype(np.uint32)
    chosen = np.unique(keys)[::3]
    for kind in (np.uint32, np.uint64):
        at, which = repair._found(keys.astype(kind), chosen.astype(kind))
        assert at.tolist() == np.flatnonzero(np.isin(keys, chosen)).tolist() and (chosen[which] == keys[at]).all()
    monkeypatch.setattr(repair, "_slot", lambda keys: (keys % 7).astype(np.uint32))
    at, which = repair._found(keys, chosen)
    assert at.tolist() == np.flatnonzero(np.isin(keys, chosen)).tolist() and (chosen[which] == keys[at]).all()


def test_ids_are_the_library_s(library):
    texts = ODD + [a + b for a in ODD for b in ODD]
    encode = tokens.PieceEncoder(vocabulary("word_bpe_49k.json"), limit=20)
    quiet = [x for x in ODD if "<|" not in x]
    ids, _ = encode(*flat_bytes(pa.array([x.encode() for x in quiet], pa.binary())))  # no special token: letters are folded first
    assert ids.tolist() == [i for e in library.encode_batch(quiet, add_special_tokens=False) for i in e.ids]
    for _ in range(3):  # the second and third time some pieces are known and some were dropped
        ids, counts = encode(*flat_bytes(pa.array([x.encode() for x in texts], pa.binary())))
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for x in want for i in x]


def rows_of(library, rows):
    """(doc_id, start, n_tokens, crc) by the library alone; rows of one id count as the same."""
    out, at = set(), 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.add((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_files_against_the_library(spark, library, tmp_path):
    long = " ".join(f"w{k % 700} common words" for k in range(3000))
    rows = [(k * 7 % 1009, x) for k, x in enumerate(ODD)] + [(2000, None), (None, "lost id"), (3000, long), (3001, "after")]
    rows += [(5000 + k, "one text that many rows hold") for k in range(300)] + [(9999, "twice"), (9999, "twice")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, shard string, ids int").repartition(5)
    folder = str(tmp_path / "ids")
    tokens.encoded(df, vocabulary("word_bpe_49k.json"), block=500).write.parquet(folder)
    segments = spark.read.parquet(folder)
    assert segments.filter("size(blocks) > 2").count() >= 1  # the long text lies in several blocks
    got = tokens.decoded(segments).collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == rows_of(library, rows)
    want = {i: [*library.encode(x or "", add_special_tokens=False).ids, 2] for i, x in rows}
    asked = [(3000, a, 40) for a in range(0, len(want[3000]), 997)] + [(2000, 0, 5), (5007, 2, 3), (4242, 0, 1), (3001, 1, 99), (0, 3, 4)]
    parts = tokens.stretches(segments, spark.createDataFrame(asked, "doc_id long, start long, length long")).collect()
    assert len(parts) == len(asked) - 1
    assert all(r.ids == want[r.doc_id][r.start:r.start + r.length] for r in parts)
    assert tokens.decoded(tokens.encoded(df.limit(0), vocabulary("word_bpe_49k.json"))).count() == 0


def test_query_on_the_whole_table(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert {tuple(r) for r in QUERIES["op11_repair"](spark, small).collect()} == rows_of(library, [tuple(r) for r in docs])


def test_rows_with_one_id_and_text_fill_several_tasks(spark):
    df = spark.range(4000).select(F.lit(1).alias("doc_id"), F.lit("the same text").alias("text")).repartition(6)
    segments = tokens.encoded(df, vocabulary("word_bpe_49k.json"))
    got = tokens.decoded(segments)
    assert got.select("start").distinct().count() == 4000 and got.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] == 16000
