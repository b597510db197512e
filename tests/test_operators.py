"""Operators against brute force, with one key or value holding a third of the rows."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lopside.functions.numbers import alarms_per_hit
from lopside.operators import confusion as C
from lopside.operators import encode as E
from lopside.operators import explain as I
from lopside.operators import overlap as O
from lopside.operators import profile as P
from lopside.operators import ranking as R
from lopside.operators import sorted_passes as S
from lopside.operators import splits as L
from lopside.operators import thresholds as T
from lopside.operators import tfidf as V
from lopside.operators.history import velocity
from lopside.operators.lookups import split_join
from lopside.operators.multilabel import coarser, label_scores, subset_accuracy


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; a third share one value, a third one group, ties everywhere."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        value = 1.0 if i % 3 == 0 else round(rng.gauss(0, 2), 2)
        group = "hot" if i % 3 == 1 else f"g{rng.randrange(5)}"
        rows.append((i, group, value, rng.randrange(4) * 0.25, int(rng.random() < 0.1)))
    pdf = pd.DataFrame(rows, columns=["id", "g", "v", "w", "y"])
    return spark.createDataFrame(pdf).repartition(8).cache(), pdf


def test_quantiles_are_exact(skewed):
    df, pdf = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = S.exact_quantiles(df, ["v", "w"], probs, ["g"]).toPandas()
    assert len(got) == pdf.g.nunique() * 2 * len(probs)
    for row in got.itertuples():
        want = pdf.loc[pdf.g == row.g, row.column].quantile(row.p)
        assert row.value == pytest.approx(want, abs=1e-12)


def test_quantiles_skip_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,), (float("nan"),), (2.0,)], "x double")
    assert S.exact_quantiles(df, ["x"], [0.25]).first()["value"] == 1.5


def test_running_totals(skewed):
    df, pdf = skewed
    one = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = S.running_totals(one, "v", ["n"], ["g"], descending=True).toPandas().sort_values(["g", "v"])
    want = pdf.groupby(["g", "v"]).size().rename("n").reset_index()
    want["cum"] = want.sort_values("v", ascending=False).groupby("g")["n"].cumsum()
    want = want.sort_values(["g", "v"])
    assert got.cum_n.tolist() == want.cum.tolist()
    assert got.all_n.tolist() == want.groupby("g")["n"].transform("sum").tolist()


def test_spearman_averages_ties(skewed):
    df, pdf = skewed
    got = S.spearman(df, "v", "w").first()
    assert got["n"] == len(pdf)
    assert got["spearman"] == pytest.approx(pdf.v.rank().corr(pdf.w.rank()), abs=1e-12)


def test_numbering_is_a_permutation(skewed):
    df, pdf = skewed
    rows = S.numbered(df.select("id"), S.hash_key(F.col("id"), 1)).orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(1, len(pdf) + 1))
    assert [r["id"] for r in rows] != sorted(r["id"] for r in rows)


def test_lookup_join_keeps_every_row(spark, skewed):
    df, pdf = skewed
    lookup = spark.createDataFrame([(g, i) for i, g in enumerate(pdf.g.unique())], "g string, k int")
    joined = S.lookup_join(df, lookup, ["g"])
    assert joined.count() == len(pdf)
    assert joined.groupBy("g").agg(F.countDistinct("k").alias("c")).filter("c <> 1").count() == 0


GOLD = [(0.9, 1), (0.8, 0), (0.8, 1), (0.4, 0), (0.3, 1)]


def test_ranking_metrics_of_the_worked_example(spark):
    df = spark.createDataFrame(GOLD, "p double, y int")
    got = R.rank_metrics(R.ranking_points(df, "y", "p")).first()
    assert got["average_precision"] == pytest.approx(0.7555555555555555)
    assert got["roc_auc"] == pytest.approx(0.5833333333333334)


def brute_metrics(y, p):
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ap, before = 0.0, 0.0
    for cut in sorted(set(p), reverse=True):
        flagged = p >= cut
        recall = y[flagged].sum() / y.sum()
        ap += (recall - before) * y[flagged].sum() / flagged.sum()
        before = recall
    return auc, ap


def test_ranking_metrics_by_group(skewed):
    df, pdf = skewed
    got = R.rank_metrics(R.ranking_points(df, "y", "v", ["g"]), ["g"]).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        auc, ap = brute_metrics(part.y.to_numpy(), part.v.to_numpy())
        assert got.loc[g, "roc_auc"] == pytest.approx(auc)
        assert got.loc[g, "average_precision"] == pytest.approx(ap)


def test_curves_have_their_end_points(spark):
    df = spark.createDataFrame(GOLD, "p double, y int")
    roc = [tuple(r) for r in R.roc_curve(df, "y", "p").orderBy(F.desc("threshold")).collect()]
    assert roc[0] == (0.0, 0.0, float("inf")) and roc[-1][:2] == (1.0, 1.0)
    pr = R.pr_curve(df, "y", "p").filter("threshold is null").collect()
    assert [tuple(r) for r in pr] == [(1.0, 0.0, None)]


def test_precision_at_recall_takes_the_lowest_threshold_on_a_tie(spark):
    df = spark.createDataFrame([(1.0, 0.5, 0.9), (1.0, 1.0, 0.8), (1.0, 1.0, 0.7), (0.5, 1.0, 0.1)],
                               "precision double, recall double, threshold double")
    rows = {r["target_recall"]: r["threshold"] for r in R.best_precision_at_recall(df, [0.4, 0.95]).collect()}
    assert rows == {0.4: 0.7, 0.95: 0.7}


def test_sweep_counts_scores_on_the_threshold(spark):
    rows = [(0.05, 1, 10.0), (0.06, 1, 20.0), (0.95, 0, 5.0), (0.0499, 1, 7.0), (1.0, 1, 1.0)]
    df = spark.createDataFrame(rows, "p double, y int, a double")
    got = T.cost_curve(df, "y", "p", F.col("a"), 5.0).toPandas().sort_values("threshold").reset_index(drop=True)
    assert len(got) == 91
    from lopside.functions.numbers import THRESHOLDS
    for row in got.itertuples():
        want = sum(a for p, y, a in rows if y and p < row.threshold)
        alarms = sum(1 for p, y, a in rows if not y and p >= row.threshold)
        assert row.fraud_loss == want and row.alarm_cost == 5.0 * alarms
    assert got.threshold.tolist() == THRESHOLDS


def test_best_row_is_the_first_on_a_tie(spark):
    df = spark.createDataFrame([(0.3, 1.0), (0.1, 1.0), (0.2, 2.0)], "threshold double, c double")
    assert T.best_by(df, "c", "min").first()["threshold"] == 0.1
    assert T.best_by(df, "c", "max").first()["threshold"] == 0.2


@pytest.mark.parametrize("counts, want", [
    ((550919, 2655, 164, 1981), {"recall": 0.924, "precision": 0.427}),
    ((1422, 171, 131, 276), {"recall": 0.6781, "precision": 0.6174, "f1": 0.6464, "accuracy": 0.8490}),
    ((903, 0, 6, 125), {"precision": 1.0, "recall": 0.9542, "f1": 0.9766, "accuracy": 0.9942})])
def test_published_confusion_counts(spark, counts, want):
    df = spark.createDataFrame([counts], "tn long, fp long, fn long, tp long")
    got = C.binary_scores(df).first()
    for name, value in want.items():
        digits = len(str(value).split(".")[1])
        assert round(got[name], digits) == value


def test_scores_without_positives_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    got = C.binary_report(df, "y", "p").first()
    assert (got["precision"], got["recall"], got["f1"], got["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_report_covers_labels_that_are_only_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "a")], "t string, p string")
    report = C.class_report(df, "t", "p")
    got = {r["label"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in report.collect()}
    assert got == {"a": (0.5, 0.5, 0.5, 2), "b": (0.0, 0.0, 0.0, 1), "c": (0.0, 0.0, 0.0, 0)}
    totals = C.report_totals(report).first()
    assert totals["macro_f1"] == pytest.approx(0.5 / 3) and totals["classes_predicted"] == 2
    assert C.full_report(report).count() == 6


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.5, 1.0])
def test_split_takes_the_exact_share_of_each_class(skewed, fraction):
    df, pdf = skewed
    flagged = L.with_test_flag(df, "g", "id", fraction).toPandas()
    assert len(flagged) == len(pdf)
    for g, part in flagged.groupby("g"):
        assert part.in_test.sum() == int(fraction * len(part) + 0.5)


def test_split_does_not_depend_on_the_layout(skewed):
    df, _ = skewed
    a = L.stratified_split(df, "g", "id")[1].select("id").toPandas()
    b = L.stratified_split(df.repartition(3).orderBy(F.desc("v")), "g", "id")[1].select("id").toPandas()
    assert set(a.id) == set(b.id)


def test_folds_are_balanced(skewed):
    df, _ = skewed
    sizes = L.with_fold(df, "g", "id", 5).groupBy("g", "fold").count().toPandas()
    spread = sizes.groupby("g")["count"].agg(["min", "max", "size"])
    assert (spread["max"] - spread["min"] <= 1).all() and (spread["size"] == 5).all()


@pytest.mark.parametrize("n", [1, 600, 5000])
def test_sample_size(skewed, n):
    df, pdf = skewed
    assert L.fixed_sample(df, "id", n).count() == min(n, len(pdf))


def test_balanced_weights_sum_to_the_rows(skewed):
    df, pdf = skewed
    weighted = L.with_class_weight(df, "y").agg(F.sum("weight")).first()[0]
    assert weighted == pytest.approx(len(pdf))


def test_first_copy_survives(spark):
    df = spark.createDataFrame([(3, "a", "x"), (1, "a", "y"), (2, "b", None)], "id int, m string, l string")
    rows = [tuple(r) for r in P.dedup_first(df, ["m"], "id").orderBy("id").collect()]
    assert rows == [(1, "a", "y"), (2, "b", None)]
    assert [tuple(r) for r in P.duplicates_by_class(df, "m", "l", "id").collect()] == [("x", 1)]


def test_duplicates_treat_missing_as_equal(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, m string")
    assert P.duplicate_count(df, ["m"]).first()["n_duplicates"] == 1
    assert P.distinct_combinations(df, ["m"]).first()["n_groups"] == 1


def test_defaults_break_ties_downwards(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (4, None)], "n int, c string")
    got = {r["column"]: (r["median"], r["mode"]) for r in P.dataset_defaults(df, ["n"], ["c"]).collect()}
    assert got == {"n": (2.0, None), "c": (None, "a")}
    holes = spark.createDataFrame([(None, None), (9, "z")], "n int, c string")
    rows = [tuple(r) for r in P.fill_defaults(holes, P.dataset_defaults(df, ["n"], ["c"]), ["n", "c"]).collect()]
    assert rows == [(2, "a"), (9, "z")]


def test_describe_matches_pandas(skewed):
    df, pdf = skewed
    got = P.describe(df, ["v"], ["g"]).toPandas().set_index("g")
    want = pdf.groupby("g")["v"].describe()
    for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                         ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        assert got[ours].to_dict() == pytest.approx(want[theirs].to_dict())


def test_density_close_to_the_exact_kernel_sum(skewed):
    df, pdf = skewed
    got = P.density_estimate(df, F.col("v"), "y").toPandas()
    for y, part in pdf.groupby("y"):
        mine = got[got.y == y].sort_values("i")
        v = part.v.to_numpy()
        h = len(v) ** -0.2 * v.std(ddof=1)
        want = np.exp(-((mine.x.to_numpy()[:, None] - v) / h) ** 2 / 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
        assert len(mine) == 200
        assert np.abs(mine.density.to_numpy() - want).max() < 3e-3 * want.max()


def test_overlap_and_alignment(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, t string")
    b = spark.createDataFrame([(2, "y"), (3, "z"), (4, "y")], "id int, t string")
    for long_text in (False, True):
        got = O.key_overlap(a, b, "t", long_text).first()
        assert (got["shared"], got["shared_rows_b"], got["rows_b"]) == (1, 2, 3)
    got = O.alignment_report(a, b, "id", ["t"]).first()
    assert tuple(got) == (2, 1, 1, 1)


def test_velocity_sees_only_the_past(spark):
    rng = random.Random(3)
    base = pd.Timestamp("2024-01-01")
    rows = [(i, 1 if i % 3 else rng.randrange(4), base + pd.Timedelta(seconds=rng.randrange(4 * 86400) // 600 * 600),
             float(rng.randrange(100))) for i in range(400)]
    pdf = pd.DataFrame(rows, columns=["id", "card", "at", "amt"])
    df = spark.createDataFrame(pdf).withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = velocity(df, "id", "card", "at", "amt").toPandas().set_index("id")
    for r in pdf.itertuples():
        past = pdf[(pdf.card == r.card) & (pdf["at"] < r.at)]
        mine = got.loc[r.id]
        assert mine.last_1h == (past["at"] >= r.at - pd.Timedelta(hours=1)).sum()
        assert mine.last_24h == (past["at"] >= r.at - pd.Timedelta(hours=24)).sum()
        assert mine.n_past == len(past)
        if len(past):
            assert mine.past_mean == pytest.approx(past.amt.mean())
            assert mine.seconds_since_last == (r.at - past["at"].max()).total_seconds()
        else:
            assert pd.isna(mine.past_mean) and pd.isna(mine.seconds_since_last)


def test_tfidf_by_hand(spark):
    texts = {1: "aa bb aa", 2: "bb cc", 3: "bb"}
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    got = {(r["id"], r["term"]): r["weight"] for r in V.tfidf_long(df, "id", "t").collect()}
    idf = {"aa": np.log(4 / 2) + 1, "bb": np.log(4 / 4) + 1, "cc": np.log(4 / 2) + 1}
    a, b = (1 + np.log(2)) * idf["aa"], idf["bb"]
    assert got[1, "aa"] == pytest.approx(a / np.hypot(a, b))
    assert got[3, "bb"] == pytest.approx(1.0)
    assert set(V.vocabulary(V.term_counts(df, "id", "t"), 2).toPandas().term) == {"bb"}


def test_unseen_terms_vanish(spark):
    train = spark.createDataFrame([(1, "aa bb"), (2, "aa")], "id int, t string")
    test = spark.createDataFrame([(9, "aa zz")], "id int, t string")
    rows = V.tfidf_apply(train, test, "id", "t").collect()
    assert [(r["term"], r["weight"]) for r in rows] == [("aa", 1.0)]


def test_encoding(spark):
    df = spark.createDataFrame([("F", 1.0, 5.0), ("M", 3.0, 5.0), ("X", 5.0, 5.0)], "s string, n double, k double")
    found = E.categories(df, ["s"])
    assert found == {"s": ["F", "M", "X"]}
    new = spark.createDataFrame([("F",), ("M",), ("Z",), (None,)], "s string")
    rows = [tuple(r) for r in new.select(*E.dummies("s", found["s"])).collect()]
    assert rows == [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]
    scaled = [r["n"] for r in E.standardise(df, ["n", "k"]).orderBy("n").collect()]
    assert scaled == pytest.approx([-1.224744871391589, 0.0, 1.224744871391589])
    assert {r["k"] for r in E.standardise(df, ["n", "k"]).collect()} == {0.0}


def test_multilabel(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "a"]), (["a"], ["c"])], "t array<string>, p array<string>")
    assert subset_accuracy(df, "t", "p").first()["subset_accuracy"] == 0.5
    got = {r["label"]: r["f1"] for r in label_scores(df, "t", "p").collect()}
    assert got == pytest.approx({"a": 2 / 3, "b": 1.0, "c": 0.0})
    mapping = spark.createDataFrame([("a", "X")], "fine string, group string")
    labels = spark.createDataFrame([("a",), ("q",)], "l string")
    assert {r["l"] for r in coarser(labels, "l", mapping, "fine", "group").collect()} == {"X", "q"}


def test_importance_finds_the_used_column(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(i, int(rng.random() < 0.3), rng.random(), rng.random()) for i in range(600)],
                               "id int, y int, a double, b double").withColumn("a", F.col("a") + F.col("y"))
    got = I.permutation_importance(lambda d: d.withColumn("p", F.col("a")), df, "id", "y", ["a", "b"], repeats=3)
    rows = {r["column"]: r["importance"] for r in got.collect()}
    assert rows["a"] > 0.2 and rows["b"] == pytest.approx(0.0)


def test_shuffled_copies_are_permutations(skewed):
    df, pdf = skewed
    got = I.shuffled_copies(df.select("id", "v", "g"), "id", ["v", "g"], 2).toPandas()
    assert len(got) == 5 * len(pdf)
    for (column, _), part in got.groupby(["column", "repeat"]):
        merged = part.merge(pdf, on="id")
        for c in ("v", "g"):
            assert sorted(part[c]) == sorted(pdf[c])
            moved = (merged[f"{c}_x"] != merged[f"{c}_y"]).mean()
            assert moved > 0.5 if c == column else moved == 0


def test_missing_hours_are_skipped(spark):
    rates = spark.createDataFrame([(0, 1.0), (1, 0.0), (5, 0.5)], "hour int, r double")
    got = {r["window"]: r["m"] for r in I.hour_windows(rates, "hour", "r", "m").collect()}
    assert got == {"00:00-03:59": 0.5, "04:00-11:59": 0.5, "12:00-21:59": None, "22:00-23:59": None}


def test_columns_are_chosen_from_the_schema(spark):
    df = spark.createDataFrame([(1, 2.0, "a", "b")], "n int, x double, s string, _c2 string")
    assert P.columns_except(df, ["s", "_c2"]) == ["n", "x"]
    assert P.columns_with_prefix(df, "_c") == ["_c2"]
    assert P.numeric_columns(df) == ["n", "x"]


def test_every_listed_operator_has_a_query():
    import os
    import re

    from lopside.queries.registry import COVERS
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(os.path.join(root, "COVERAGE.md"), encoding="utf-8") as table:
        listed = set(re.findall(r"^\| ([A-Z]\d\d) \|", table.read(), re.M))
    assert len(listed) == 195
    # C08: Spark's forests take no weights per bootstrap; see the README.
    assert listed - {"C08"} == {i for ids in COVERS.values() for i in ids.split()}


# ---- rows without a value, and narrow groups -----------------------------------------

def scored_rows(spark):
    rows = [(1, 0.5), (0, None), (1, 0.2), (0, float("nan")), (None, 0.9), (0, 0.4), (0, 0.1)]
    return spark.createDataFrame(rows, "y int, p double")


def test_rankings_and_sweeps_leave_out_rows_without_score_or_label(spark):
    from lopside.operators.ranking import rank_metrics, ranking_points
    from lopside.operators.thresholds import sweep_counts
    got = rank_metrics(ranking_points(scored_rows(spark), "y", "p")).first()
    assert abs(got.roc_auc - 0.75) < 1e-12 and abs(got.average_precision - (0.5 + 0.5 * 2 / 3)) < 1e-12
    sweep = sweep_counts(scored_rows(spark), "y", "p", thresholds=[0.3]).first()
    assert (sweep.tp, sweep.fp, sweep.positives, sweep.negatives) == (1, 1, 2, 2)
    empty = scored_rows(spark).withColumn("p", F.lit(None).cast("double"))
    assert ranking_points(empty, "y", "p").count() == 0


def test_ranks_skip_missing_values(spark):
    from lopside.operators.sorted_passes import average_ranks
    got = {r.p: r.avg_rank for r in average_ranks(scored_rows(spark).select("p"), "p").collect()}
    assert got == {0.1: 1, 0.2: 2, 0.4: 3, 0.5: 4, 0.9: 5}


def test_a_narrow_group_uses_many_buckets(spark):
    from lopside.operators.sorted_passes import BUCKET, exact_quantiles, range_buckets, running_totals
    wide = spark.range(1000).selectExpr("'wide' as g", "cast(id * 1000 as double) as v", "1L as n")
    narrow = spark.range(9000).selectExpr("cast(null as string) as g", "1 + id / 1e6 as v", "1L as n")
    both = wide.union(narrow)
    placed = range_buckets(both, ["g", "v"], rows_per_bucket=500)
    assert placed.filter("g is null").select(BUCKET).distinct().count() >= 15
    got = running_totals(both, "v", ["n"], ["g"], rows_per_bucket=500)
    bad = got.filter("cum_n <> case when g is null then round((v - 1) * 1e6) + 1 else v / 1000 + 1 end")
    assert bad.count() == 0 and got.count() == 10_000
    medians = {r.g: r.value for r in exact_quantiles(both, ["v"], [0.5], ["g"]).collect()}
    assert medians["wide"] == 499500 and abs(medians[None] - 1.0044995) < 1e-9


def test_a_column_without_values_has_no_default(spark):
    from lopside.operators.profile import dataset_defaults, fill_defaults
    df = spark.createDataFrame([(1.0, None, "a"), (None, None, None)], "x double, y double, c string")
    got = fill_defaults(df, dataset_defaults(df, ["x", "y"], ["c"]), ["x", "y", "c"]).collect()
    assert [tuple(r) for r in got] == [(1.0, None, "a"), (1.0, None, "a")]


def test_tokens_and_accents_are_those_of_python(spark):
    import re
    import unicodedata

    from lopside.functions.text import strip_accents, word_tokens
    texts = ["Café déjà x² ½½ नमस्ते שָׁלוֹם ﬁne が ＡＢ１ plain_1 ok", "only ascii", ""]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = df.select(word_tokens(F.col("t")).alias("w"), strip_accents(F.col("t")).alias("s")).collect()
    for text, row in zip(texts, got):
        assert row.w == re.findall(r"\b\w\w+\b", text.lower())
        assert row.s == "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    assert got[-1].s is None


def test_split_join_answers_hot_and_rare_keys_alike(spark):
    facts = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("term"))
    counts = facts.groupBy("term").agg(F.count("*").alias("df"))
    plain = facts.join(counts, "term").select("id", "term", "df")
    for limit in (0, 100, 10_000):  # all keys hot, one, none
        found = split_join(facts, counts, ["term"], "df", heavy_rows=limit, most=1 if limit == 10_000 else 1000)
        assert found.select("id", "term", "df").exceptAll(plain).count() == 0 and found.count() == 1000


def test_terms_are_made_once(spark):
    df = spark.createDataFrame([(1, "a word and a word"), (2, "another word"), (3, None), (4, "")], "id int, text string")
    plan = V.tfidf_long(df, "id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "LogicalRDD" in plan
    found = {(r["id"], r["term"]): r["weight"] for r in V.tfidf_long(df, "id", "text").collect()}
    assert set(found) == {(1, "word"), (1, "and"), (2, "word"), (2, "another")}
    assert abs(found[2, "word"] ** 2 + found[2, "another"] ** 2 - 1) < 1e-12


def test_terms_in_many_parts(spark, monkeypatch):
    """Parts follow the bytes of the texts; counts stay in their part, and frequent terms, repeated and missing ids change nothing."""
    rng = random.Random(9)
    rows = [(k if k % 10 else None, "hot " + " ".join(f"w{rng.randrange(60)}" for _ in range(12))) for k in range(300)] + [(7, "hot more w1"), (8, None)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(5)
    monkeypatch.setattr(V, "PART_BYTES", 500)
    monkeypatch.setattr(V, "CHAR_PART_BYTES", 2000)
    counts, parts = V.placed_counts(df, "id", "text")
    assert 20 < parts < 60 and counts.select("_part").distinct().count() > 10
    held = {}
    for i, text in rows:
        held.setdefault(i, []).extend(re.findall(r"\w\w+", text or ""))
    tf = {(i, w): ws.count(w) for i, ws in held.items() for w in set(ws)}
    freq = {w: sum(1 for _, v in tf if v == w) for _, w in tf}
    assert {(r.id, r.term): r.tf for r in V.kept_counts(df, "id", "text", 50).collect()} == {k: n for k, n in tf.items() if freq[k[1]] >= 50}
    assert {r.term: r.df for r in V.fitted_vocabulary(df, "id", "text", 50).collect()} == {w: n for w, n in freq.items() if n >= 50}
    found = V.tfidf_long(df, "id", "text", min_df=50)
    assert {(r.id, r.term): (r.tf, r.df) for r in found.collect()} == {k: (n, freq[k[1]]) for k, n in tf.items() if freq[k[1]] >= 50}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" in plan and "hashpartitioning(_part" not in plan and "hashpartitioning(id" not in plan
    new = spark.createDataFrame([(1, "hot w1 unseen"), (2, "w2")], "id long, text string")
    assert {(r.id, r.term): r.df for r in V.tfidf_apply(df, new, "id", "text").collect()} == {(1, "hot"): freq["hot"], (1, "w1"): freq["w1"], (2, "w2"): freq["w2"]}
    grams = V.kept_counts(df, "id", "text", 200, analyzer="char_wb", ngram_range=(3, 3)).select("term").distinct().collect()
    assert {" ho", "hot", "ot "} <= {r.term for r in grams}


def test_digest_keys_keep_the_rows(spark):
    rows = [(1, None, "x", 5), (2, None, "y", 6), (3, "", "x", None), (4, "", "x", 2), (5, "a", "x", None), (6, "a", "x", None)]
    df = spark.createDataFrame(rows, "id int, m string, l string, at int")
    kept = {tuple(r) for r in P.dedup_first(df, ["m"], "at").collect()}
    assert {(1, None, "x", 5), (4, "", "x", 2)} <= kept and len(kept) == 3 and kept <= set(rows)
    assert {tuple(r) for r in P.dedup_first(df, ["m", "l"], "id").collect()} == {r for r in rows if r[0] in (1, 2, 3, 5)}
    more = df.union(spark.createDataFrame([(7, "a", "y", 1), (8, "a", None, 1)], df.schema))
    assert [tuple(r) for r in P.conflicting_labels(more, "m", "l").collect()] == [("a", 2)]
    plan = P.dedup_first(df, ["m"], "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2(cast(m" in plan and "Aggregate [m" not in plan


def test_alarms_per_hit(spark):
    df = spark.createDataFrame([(0.25,), (0.0,), (None,)], "p double")
    assert [r[0] for r in df.select(alarms_per_hit(F.col("p"))).collect()] == [4.0, None, None]
