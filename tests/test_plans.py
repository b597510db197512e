"""Comparisons, search, weights and layouts of the learners, on small tables with a known answer."""

import random

import pytest
from pyspark.sql import functions as F

from lopside.plans import compare, extras
from lopside.plans.learners import fit_tabular, forest, histogram_boosting, logistic, placed, score_tabular

CATEGORICAL, NUMERIC = ["c"], ["x", "z"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for k in range(1200):
        x, c = rng.random(), rng.choice("ab")
        data.append((k, x, rng.random(), c, int(x + (c == "b") * 0.3 + rng.gauss(0, 0.15) > 0.8), 1.0 + k % 3))
    return spark.createDataFrame(data, "id long, x double, z double, c string, y int, w double")


@pytest.fixture(scope="module")
def parts(rows):
    return rows.filter("id % 4 <> 0"), rows.filter("id % 4 = 0")


def test_comparison_and_ablation(parts):
    learners = {"LR": (logistic, True), "RF": (lambda n: forest(n, trees=10), True),
                "HGB": (lambda n: histogram_boosting(n, rounds=10), False)}
    got = compare.compare_tabular(*parts, "y", CATEGORICAL, NUMERIC, learners, "id").collect()
    assert {r.model for r in got} == set(learners) and all(r.roc_auc > 0.85 and r.n_test == 300 for r in got)
    assert [r.average_precision for r in got] == sorted((r.average_precision for r in got), reverse=True)
    sets = {"all": ["c", "x", "z"], "noise": ["z"]}
    found = {r.feature_set: r for r in compare.ablation(*parts, "y", sets, CATEGORICAL, "id", logistic).collect()}
    assert found["all"].roc_auc > 0.85 > 0.65 > found["noise"].roc_auc and found["noise"].n_features == 1


def test_boosting_tasks_do_not_grow_with_the_rows(spark):
    keyed = spark.range(100).withColumn("_key", F.md5(F.col("id").cast("string")))
    few, many, huge = (placed(keyed, n).rdd.getNumPartitions() for n in (60_000, 4_800_000, 100_000_000))
    assert (few, many, huge) == (6, 48, 100) and placed(keyed, 0).rdd.getNumPartitions() == 1


def test_text_comparison_and_gain(spark):
    from lopside.plans.stages import TextTfidf
    rng = random.Random(1)
    texts = [(k, "hot" if k % 2 else "cold", " ".join(rng.choices("sun sand sea".split() if k % 2 else "ice snow wind".split(), k=6) + ["day"]))
             for k in range(120)]
    df = spark.createDataFrame(texts, "id long, label string, text string")
    train, test = df.filter("id % 3 <> 0"), df.filter("id % 3 = 0")
    vectors = {"one": TextTfidf("text"), "two": TextTfidf("text", ngram_range=(1, 2))}
    got = compare.compare_texts(train, test, "id", "label", vectors, ("MultinomialNB", "LinearSVC"), positive="hot")
    assert [r.positive_f1 for r in got.collect()] == [1.0] * 4
    assert [r.gain for r in compare.feature_set_gain(got, "one", "two").collect()] == [0.0, 0.0]


def test_repeated_folds_and_search(rows):
    got = extras.repeated_folds(rows, "y", "id", CATEGORICAL, NUMERIC, k=2, seeds=(1, 2)).first()
    assert got.fits == 4 and got.roc_auc_mean > 0.85 and 0 < got.roc_auc_std < 0.1
    space = {"maxDepth": [1, 2], "maxIter": [3]}
    found = extras.random_search(rows, "y", "id", CATEGORICAL, NUMERIC, space, tries=4, k=2).collect()
    assert 1 <= len(found) <= 2 and found[0].roc_auc >= found[-1].roc_auc > 0.7


def test_a_weight_counts_like_copies(rows):
    copies = rows.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("w").cast("int")))).drop("_n")
    one = fit_tabular(copies, "y", [], ["x", "z"], logistic).stages[-1]
    two = fit_tabular(rows, "y", [], ["x", "z"], logistic, sample_weight=F.col("w"))
    scale_free = two.stages[-1]
    same = rows.withColumn("w", F.col("w") * 1.0)
    again = fit_tabular(same, "y", [], ["x", "z"], logistic, sample_weight=F.col("w")).stages[-1]
    assert abs(scale_free.coefficients[0] - again.coefficients[0]) < 1e-9
    # Both scalers differ a little, so the raw slopes are compared after undoing them.
    assert abs(one.coefficients[0] - scale_free.coefficients[0]) < 0.05 * abs(one.coefficients[0])
    heavy = fit_tabular(rows.withColumn("w", F.lit(100.0)), "y", [], ["x", "z"], logistic, sample_weight=F.col("w")).stages[-1]
    plain = fit_tabular(rows, "y", [], ["x", "z"], logistic).stages[-1]
    assert heavy.coefficients[0] > plain.coefficients[0]  # the penalty weighs less


def test_a_forest_does_not_depend_on_the_layout(rows):
    make = lambda n: forest(n, trees=8)
    found = []
    for k in (1, 3, 8):
        model = fit_tabular(rows.repartition(k, F.rand(k)), "y", CATEGORICAL, NUMERIC, make, True, "id")
        found.append([r.p for r in score_tabular(model, rows.orderBy("id")).orderBy("id").select("p").collect()])
    assert found[0] == found[1] == found[2]
