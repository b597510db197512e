"""The whole pipeline and each stage, held against plain Python on a small table."""

import zlib

import numpy as np

import corpus_pipeline
from lopside.llm.queries import vocabulary
from test_dart import brute as brute_classes
from test_decontaminate import brute as brute_leaks
from test_lines import brute as brute_lines

FOLDER = "/root/testdata/sf0.001"


CLASHING = ["held_out", "_text", "_of", "_id", "removed", "_key", "score", "unit", "node", "label", "start", "n_units", "_toxicity"]


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "line_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        after = stage(spark, docs, FOLDER)
        if name == "packing":
            break
        after = corpus_pipeline.stored(after)
        assert after.schema.simpleString() == docs.schema.simpleString()
        left = ids(after)
        texts = {r.doc_id: r.text for r in after.collect()}
        if name == "toxicity":
            judged = [i for i, _ in before if i in toxic]
            assert sum((i not in left) == bool(toxic[i]) for i in judged) >= 0.9 * len(judged)
        elif name == "near_dedup":
            assert left == {c for _, c in brute_classes(before)}
        elif name == "line_dedup":
            given = {i: t or "" for i, t in before}
            want = {i: kept for i, (kept, _) in brute_lines(before).items() if kept == given[i] or kept.strip(" ")}
            assert texts == want and all(r.n_chars == len(r.text) for r in after.collect() if r.text != dict(before)[r.doc_id])
        else:
            assert left == {i for i, _ in before} - {d for d, *_ in brute_leaks(before, items)}
        docs = after
    from tokenizers import Tokenizer
    encode = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    tokens = {i: np.array([*encode.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for i, t in before}
    assert {r.doc_id for r in rows} == set(tokens)
    for i, raw in tokens.items():
        pieces = sorted((r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == i)
        assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1]] and sum(p[1] for p in pieces) * 4 == len(raw)
        assert all(zlib.crc32(raw[4 * a:4 * (a + n)]) == c for a, n, c in pieces)
    sequences = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= 2048


def test_odd_rows_go_through(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    clash = [f"own {c}" for c in CLASHING]
    rows = [(None, None, None, None, None, *[None] * len(clash)), (1, "", None, "s", 0, *clash), (1, "", None, "s", 0, *clash),
            (2, "word " * 50000, "en", None, None, *clash)]
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            if name != "packing":
                assert out.columns == docs.columns
                docs = corpus_pipeline.stored(out)
                assert all(r[c] in (None, f"own {c}") for r in docs.collect() for c in CLASHING)
        assert (out.count() > 0) == bool(table)
