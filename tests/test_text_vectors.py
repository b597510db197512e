"""Vocabulary, placing and partitions of the text learners, on small rows of their own."""

from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import CountVectorizer, IDF
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lopside.plans import stages
from lopside.plans.calibration import CalibratedSVC
from lopside.plans.stages import ALL_TERMS, TextTfidf, dealt, merged, term_totals, vocabulary_size


def test_terms_are_counted_in_all_and_once_a_row(spark):
    rows = [["b", "a", "b"], ["a"], ["b", "c"], [], None, ["c"]]
    df = spark.createDataFrame([(r,) for r in rows], "t array<string>")
    n, once = Counter(x for r in rows if r for x in r), Counter(x for r in rows if r for x in set(r))
    got = {r["term"]: (r["n"], r["df"]) for r in term_totals(df, "t", 2).collect()}
    assert got == {x: (n[x], once[x]) for x in n if once[x] >= 2}


def test_vocabulary_is_most_frequent_first_and_the_same_on_any_partitions(spark):
    texts = [" ".join(f"w{j:02d}" for j in range(40) if (i * j) % 7 != 3) + f" own{i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    count = Counter(w for x in texts for w in x.split())
    want = sorted((w for w in count if count[w] >= 2), key=lambda w: (-count[w], w))
    model = TextTfidf("t", min_df=2).fit(df.repartition(5))
    assert model.stages[1].vocabulary == want == TextTfidf("t", min_df=2).fit(df.coalesce(1)).stages[1].vocabulary
    assert vocabulary_size(model) == len(want)
    terms = model.stages[0].transform(df)
    plain = CountVectorizer(inputCol="_terms", outputCol="_tf", minDF=2.0, vocabSize=ALL_TERMS).fit(terms)
    idf = dict(zip(plain.vocabulary, IDF(inputCol="_tf", outputCol="_i").fit(plain.transform(terms)).idf.toArray() + 1.0))
    scale = next(s for s in model.stages if hasattr(s, "getScalingVec")).getScalingVec().toArray()
    assert scale == pytest.approx([idf[w] for w in want], rel=1e-14)


def test_no_terms_at_all(spark):
    df = spark.createDataFrame([(1, "aa"), (2, "bb")], "id int, t string")
    with pytest.raises(ValueError, match="lower min_df"):
        TextTfidf("t", min_df=2).fit(df)


def test_one_partition_of_much_text_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(stages, "WORD_TASK_BYTES", 1000)
    df = spark.range(200).selectExpr("id", "if(id % 9 = 0, null, repeat('word ', 10)) as t").coalesce(1)
    out = dealt(df, "id", "t")
    assert out.rdd.getNumPartitions() == 9 and out.exceptAll(df).count() == 0 and out.count() == 200
    sizes = [n for n, in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 60
    assert dealt(df.limit(5).coalesce(1), "id", "t").rdd.getNumPartitions() == 1


def test_wide_vectors_are_fitted_in_few_tasks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        places = sorted({i % 2, *rng.integers(2, 5000, 6).tolist()})
        rows.append((i, "ab"[i % 2], Vectors.sparse(5000, places, [1.0] * len(places))))
    df = spark.createDataFrame(rows, ["id", "label", "features"]).repartition(16, "id")
    one = merged(df, "features")
    assert one.rdd.getNumPartitions() == 1 and one.count() == 300
    monkeypatch.setattr(stages, "TASK_ENTRIES", 700)
    assert 2 <= merged(df, "features").rdd.getNumPartitions() <= 4 and merged(df.limit(0), "features").count() == 0
    scored = CalibratedSVC("label", "id", folds=0).fit(df).transform(df)
    assert scored.filter("predicted != label").count() == 0
