"""Queries of fitted models, which have no SQL: their values, and what is true of any fit."""

import pytest

from lopside.queries import QUERIES, SQL
from lopside.queries.registry import HOLDS

METRICS = {"precision", "recall", "f1", "roc_auc", "baseline_accuracy", "n_test"}
RESULTS = {
    "fraud_learner_comparison": {"model"} | METRICS, "fraud_ablation": {"feature_set", "n_features"} | METRICS,
    "churn_learner_comparison": {"model"} | METRICS, "churn_training": METRICS, "fraud_training": {"false_alarm_cost"} | METRICS,
    "churn_impurity_importance": {"feature", "importance"}, "churn_permutation_importance": {"column", "importance", "std"},
    "fraud_permutation_importance": {"column", "importance", "std"}, "amount_weighted_learner": {"model"} | METRICS,
    "repeated_fold_metrics": {"fits", "roc_auc_mean", "roc_auc_std", "average_precision_mean", "average_precision_std"},
    "word_and_char_union": {"label", "precision", "recall", "f1", "support"}, "top_genres": {"id", "predicted", "predictions"},
    "scored_transactions": {"row_id", "p", "decision", "band"}, "swept_transactions": {"hour", "decision", "n", "mean_p"},
    "scored_customers": {"CustomerId", "p", "prediction", "risk_band"},
    "scored_messages": {"row_id", "label", "spam_probability", "confidence", "json"},
    "genre_job": {"id", "predicted", "predictions", "calibrated_accuracy"}, "message_job": {"row_id", "label", "spam_probability", "f1"},
    "stream_scored_transactions": {"row_id", "p", "decision"}, "scores_from_saved_bundle": {"CustomerId", "p", "threshold"}}


def test_no_sql_of_constants():
    assert not {n for n in SQL if "true as" in SQL[n]} and set(HOLDS) == set(RESULTS)


@pytest.mark.parametrize("name", sorted(RESULTS))
def test_results(name, spark, small):
    """The values a user asks for are there, and what holds for any fitted model holds."""
    found = QUERIES[name](spark, small).cache()
    assert RESULTS[name] <= set(found.columns)
    rows = found.toPandas()
    assert len(rows) and rows[sorted(RESULTS[name])].notna().all().all()
    checks = HOLDS[name](found)
    truths = [c for c, kind in checks.dtypes if kind == "boolean"]
    assert truths and all(all(r[c] is True for c in truths) for r in checks.collect())
    found.unpersist()
