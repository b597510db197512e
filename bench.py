"""Headline queries, timed one after another; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from lopside import build_session
from lopside.queries import QUERIES

HEADLINE = [
    "transaction_features", "best_cost_threshold", "cost_threshold_curve", "f1_threshold_curve",
    "ranking_metrics", "ranking_metrics_by_category", "roc_curve", "precision_at_recall_targets",
    "binary_report", "full_class_report", "top_confusions", "money_summary",
    "amount_and_distance_by_class", "category_class_medians", "churn_rate_breakdowns",
    "correlation_matrix", "churn_defaults", "identity_audit", "card_velocity", "first_messages",
    "stratified_split", "fixed_size_sample", "text_leak_without_dedup", "word_tokens", "vocabulary_size",
    "tfidf_weights", "char_ngrams", "term_contrast", "hour_window_faithfulness", "scored_transactions"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    QUERIES[names[0]](spark, folder).limit(1).collect()  # start the JVM's engines
    times = {}
    for name in names:
        start = time.perf_counter()
        # A full run of every row and column, without moving them to Python.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_wall_clock", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": folder.rstrip("/").split("sf")[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
