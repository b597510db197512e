"""Queries that must work on every row they are given."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from lopside.functions.transactions import FEATURES
from lopside.queries import learners, registry


def test_importance_is_measured_on_every_held_out_row(monkeypatch, spark):
    def rows(n):
        columns = [F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias(c) if c in learners.CATEGORICAL
                   else F.pmod(F.xxhash64("id"), F.lit(97)).cast("double").alias(c) for c in FEATURES]
        return spark.range(n).select(F.col("id").alias("row_id"), (F.col("id") % 5 == 0).cast("int").alias("is_fraud"), *columns)

    seen = []
    monkeypatch.setattr(learners, "fit_tabular", lambda *a, **k: None)
    monkeypatch.setattr(learners, "permutation_importance", lambda score, df, *a, **k: seen.append(df.count()))
    monkeypatch.setattr(registry, "Tables", lambda spark, folder: SimpleNamespace(feature_parts=(rows(30), rows(60_007))))
    registry.QUERIES["fraud_permutation_importance"](spark, "")
    assert seen == [60_007]
