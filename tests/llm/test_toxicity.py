"""Held-out accuracy, misspellings, and odd rows."""

import zlib

from pyspark.sql import functions as F

from lopside.llm import toxicity

ODD = "doc_id long, text string, lang string, score string"


def test_held_out_accuracy(spark, small):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.classified(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.9


def test_misspelling_and_odd_rows(spark):
    plain = ["the cat sat on a mat", "we went home by train", "it rains in may and june", "bread and milk are here"]
    rows = [(i, f"{plain[i % 4]} {plain[i % 3]}" + (" you stupidhead" if i // 12 % 2 else ""), "en", "x") for i in range(200)]
    docs = spark.createDataFrame(rows, ODD)
    labels = docs.select("doc_id", (F.floor(F.col("doc_id") / 12) % 2).cast("int").alias("toxic"), F.lit(1).alias("text"))
    labels = labels.union(labels.limit(1)).union(spark.createDataFrame([(None, 1, 1), (5, None, 1)], labels.schema))
    model = toxicity.train(docs, labels)
    odd = [(1000, "we went home you stupidheaad", "en", None), (1001, "bread and milk", "en", None), (1002, None, None, None),
           (1003, "", None, None), (None, "it rains", None, None), (1001, "bread and milk", "en", None),
           (1004, "bread " * 20000 + "stupidhead you", "en", None)]
    got = toxicity.score(spark.createDataFrame(odd, ODD), model)
    assert set(got.columns) >= {"doc_id", "score", "held_out"}
    score = {r.doc_id: r.score for r in got.collect()}
    assert score[1000] > 0.5 > score[1001] and score[1004] > score[1001] and score[1002] == score[1003]
    assert all(0 <= s <= 1 for s in score.values())
    assert got.limit(0).count() == 0 and toxicity.score(spark.createDataFrame([], ODD), model).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s")], ODD)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.classified(docs, labels).collect()] == [0]


def test_memory_does_not_follow_the_sample():
    """What the work arrays need beside the sample itself; they are made for some words and texts at a time."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(0)
    words = np.array([f"word{k}" for k in range(60_000)])
    peaks = []
    for copies in (1, 8):
        texts = [" ".join(rng.choice(words, 6000)) + (" you idiot" if k % 3 == 0 else "") for k in range(75 * copies)]
        data = pa.array([t.encode() for t in texts], pa.binary())
        labels = np.array([k % 3 == 0 for k in range(len(texts))]).astype(np.int64)
        tracemalloc.start()
        toxicity.fit(data, labels, turns=1, rounds=1)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    size = sum(map(len, texts))
    assert size > 30e6 and peaks[1] < 12 * size, (size, peaks)


def test_repeated_ids_are_one_row(spark):
    rows = [(k % 40, f"text {k} of many" + (" you stupidhead" if k % 40 < 20 else " is fine"), "en", "x") for k in range(4000)]
    docs = spark.createDataFrame(rows, ODD)
    labels = spark.createDataFrame([(k, int(k < 20)) for k in range(40)], "doc_id long, toxic int")
    one = toxicity.train(docs, labels)
    assert one[0] == toxicity.train(docs.repartition(9), labels)[0]
    clash = docs.limit(1).withColumnRenamed("lang", "held_out").withColumnRenamed("score", "_text")
    assert toxicity.score(clash, one).columns == ["doc_id", "text", "_text", "score", "held_out"]
