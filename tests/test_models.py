"""Invariants of the learners, the calibration, saved bundles and streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lopside.operators.confusion import class_report, report_totals
from lopside.operators.ranking import roc_auc
from lopside.operators.splits import stratified_split
from lopside.operators.tfidf import tfidf_long
from lopside.plans import scoring, training
from lopside.plans.calibration import CalibratedSVC, platt
from lopside.plans.learners import (boosting, fit_tabular, forest, impurity_importance, logistic,
                                    score_tabular)
from lopside.plans.stages import TabularEncoder, TextTfidf, vocabulary_size
from lopside.sources import sinks
from lopside.sources.standins import CHURN_CATEGORICAL, CHURN_NUMERIC, Tables
from lopside.streaming.streams import drop_repeats, read_files, run_to_parquet, score_stream


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def genre(tables):
    text = F.col("description").alias("text")
    return stratified_split(tables.genre.select("id", "genre", "source", text), "genre", "id")


@pytest.fixture(scope="module")
def vectors(genre):
    tfidf = TextTfidf("text", min_df=2).fit(genre[0])
    return tfidf, tfidf.transform(genre[0]).cache(), tfidf.transform(genre[1]).cache()


def test_vectors_equal_the_long_form(spark):
    df = spark.createDataFrame([(1, "aa bb aa cc"), (2, "bb cc dd"), (3, "dd"), (4, "zz")], "id int, t string")
    model = TextTfidf("t", min_df=2).fit(df)
    terms = model.stages[1].vocabulary
    assert vocabulary_size(model) == 3
    want = {(r["id"], r["term"]): r["weight"] for r in tfidf_long(df, "id", "t", min_df=2).collect()}
    got = {}
    for r in model.transform(df).collect():
        got.update({(r["id"], terms[i]): v for i, v in zip(r["features"].indices, r["features"].values)})
    assert got == pytest.approx(want)


def test_hashed_vectors_have_length_one(spark):
    df = spark.createDataFrame([(1, "aa bb aa cc"), (2, "bb cc dd")], "id int, t string")
    for r in TextTfidf("t", hashed=64).fit(df).transform(df).collect():
        assert r["features"].size == 64 and r["features"].norm(2) == pytest.approx(1.0)


def test_language_is_learnable_and_calibration_gives_probabilities(vectors, genre):
    _, seen, unseen = vectors
    for folds in (0, 3):
        model = CalibratedSVC("genre", "id", folds=folds).fit(seen)
        scored = model.transform(unseen)
        assert report_totals(class_report(scored, "genre", "predicted")).first()["macro_f1"] > 0.9
        assert not [c for c in scored.columns if c.startswith("_")]
    total = F.aggregate("probabilities", F.lit(0.0), lambda s, x: s + x)
    assert scored.filter(F.abs(total - 1) > 1e-9).count() == 0
    top = scoring.top_classes(F.col("probabilities"), ["de", "en", "es", "fr"], 2)
    for r in scored.select(top.alias("t"), "predicted").limit(20).collect():
        assert len(r["t"]) == 2 and r["t"][0]["genre"] == r["predicted"]
        assert r["t"][0]["probability"] >= r["t"][1]["probability"]


def test_platt_finds_the_sigmoid(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=4000)
    rows = []
    for k, (a, b) in enumerate([(-2.0, 0.5), (-0.5, -1.0)]):
        y = rng.random(4000) < 1 / (1 + np.exp(a * m + b))
        rows += [(k, float(x), int(t)) for x, t in zip(m, y)]
    found = platt(spark.createDataFrame(rows, "k int, margin double, y int"), ["k"])
    assert found[(0,)] == pytest.approx((-2.0, 0.5), abs=0.25)
    assert found[(1,)] == pytest.approx((-0.5, -1.0), abs=0.25)


@pytest.fixture(scope="module")
def churn(tables):
    return stratified_split(tables.churn, "Exited", "CustomerId")


@pytest.mark.parametrize("learner", [logistic, lambda n: forest(n, trees=20), lambda n: boosting(n, rounds=15)])
def test_tabular_learners_rank_better_than_chance(churn, learner):
    model = fit_tabular(churn[0], "Exited", CHURN_CATEGORICAL, CHURN_NUMERIC, learner)
    scored = score_tabular(model, churn[1])
    assert scored.count() == churn[1].count()
    assert scored.filter("p < 0 or p > 1").count() == 0
    assert roc_auc(scored, "Exited", "p").first()["roc_auc"] > 0.6


def test_encoder_names_and_unknowns(spark, churn):
    encoder = TabularEncoder(["Gender"], ["Age"]).fit(churn[0])
    assert encoder.feature_names == ["Gender_Male", "Age"]
    new = spark.createDataFrame([("Other", 40)], "Gender string, Age int")
    assert encoder.transform(new).first()["features"][0] == 0.0
    assert encoder.unknown_counts(new).first()["Gender"] == 1


def test_importance_has_every_encoded_feature(spark, churn):
    model = fit_tabular(churn[0], "Exited", CHURN_CATEGORICAL, CHURN_NUMERIC, lambda n: boosting(n, rounds=10))
    rows = impurity_importance(model, spark).orderBy(F.desc("importance")).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert {"Geography_ASIA", "Gender_Male", "NumOfProducts"} < {r["feature"] for r in rows}


def test_churn_bundle_round_trip(spark, tables, churn, tmp_path):
    folder = str(tmp_path / "churn")
    trained = training.train_churn(tables.churn, "CustomerId", "Exited", CHURN_CATEGORICAL, CHURN_NUMERIC,
                                   learner=lambda n: boosting(n, rounds=5), folder=folder)
    bundle = sinks.load_bundle(spark, folder)
    assert bundle.threshold == trained.threshold and bundle.meta["n_train"] == tables.churn.count()
    assert bundle.meta["engine_version"] == spark.version and bundle.meta["features"][0] == "Geography"
    a = score_tabular(trained.model, churn[1]).select("CustomerId", "p")
    b = score_tabular(bundle.model, churn[1]).select("CustomerId", "p")
    assert a.exceptAll(b).count() == 0


def test_message_bundle_round_trip_and_stream(spark, tables, tmp_path):
    folder = str(tmp_path / "sms")
    training.train_messages(tables.sms_unique, folds=2, refit=False, folder=folder)
    bundle = sinks.load_bundle(spark, folder)
    assert bundle.labels == ["ham", "spam"] and bundle.threshold == 0.5
    source = str(tmp_path / "in")
    tables.sms_unique.select("row_id", "message").repartition(3).write.parquet(source)

    def score(df):
        return scoring.score_messages(bundle.model, df, bundle.threshold).select("row_id", "label", "spam_probability")

    stream = read_files(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    score_stream(stream, score, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    batch = score(spark.read.parquet(source))
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert streamed.count() == batch.count() and streamed.exceptAll(batch).count() == 0


def test_stream_keeps_the_first_of_each_message(spark, tmp_path):
    rows = [(i, f"m{i % 50}", f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}") for i in range(100)]
    df = spark.createDataFrame(rows, "id int, message string, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    df.write.parquet(str(tmp_path / "in"))
    stream = read_files(spark, str(tmp_path / "in"), df.schema)
    run_to_parquet(drop_repeats(stream, "message", "at"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_fraud_threshold_modes(tables, tmp_path):
    train, test = tables.txn_parts
    chosen = training.train_fraud(train, test, trees=10)
    flattering = training.train_fraud(train, test, trees=10, tune_on="test")
    given = training.train_fraud(train, test, trees=10, threshold=0.19)
    assert given.threshold == 0.19 and 0.05 <= chosen.threshold <= 0.95
    best = flattering.metrics.first()["net_saving"]
    assert best >= given.metrics.first()["net_saving"] - 1e-6
    assert best >= chosen.metrics.first()["net_saving"] - 1e-6
