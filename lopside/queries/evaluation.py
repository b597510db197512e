"""Curves, thresholds, confusion tables and money."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lopside.functions.numbers import (FINE_THRESHOLDS, THRESHOLDS, alarms_per_hit, at_least, blank_small, f1_band)
from lopside.functions.text import shorten
from lopside.operators import confusion as C
from lopside.operators import ranking as R
from lopside.operators import thresholds as T
from lopside.operators.multilabel import coarser, label_scores, reliability, subset_accuracy
from lopside.operators.sorted_passes import spearman
from lopside.queries.registry import double_list, query, r6, rounded

# Running counts by descending score over the whole table.
POINTS = """
  p as (select score, cast(sum(is_fraud) as bigint) as pos, cast(sum(1 - is_fraud) as bigint) as neg from txn group by score),
  points as (select score, pos, neg, cast(sum(pos) over (order by score desc) as bigint) as tp,
    cast(sum(neg) over (order by score desc) as bigint) as fp, cast(sum(pos) over () as bigint) as positives,
    cast(sum(neg) over () as bigint) as negatives from p)"""
GRID = f"select unnest({double_list(THRESHOLDS)}) as threshold"
FINE = f"select unnest({double_list(FINE_THRESHOLDS)}) as threshold"
SWEEP = f"""
  grid as ({GRID}),
  s as (select threshold,
    cast(sum(case when is_fraud = 1 and score >= threshold then 1 else 0 end) as bigint) as tp,
    cast(sum(case when is_fraud = 0 and score >= threshold then 1 else 0 end) as bigint) as fp,
    cast(sum(is_fraud) as bigint) as positives,
    sum(case when is_fraud = 1 and score < threshold then amt else 0 end) as fraud_loss
    from grid cross join txn group by threshold),
  cost as (select threshold, fraud_loss, fp * 5.0e0 as alarm_cost, fraud_loss + fp * 5.0e0 as total_cost,
    tp / positives as recall, case when tp + fp > 0 then tp / (tp + fp) else 0 end as precision,
    2 * tp / (tp + fp + positives) as f1 from s)"""


def predicted(t) -> DataFrame:
    return t.txn.withColumn("pred", at_least(F.col("score"), 0.5))


@query("ranking_points", "W03", sql=f"with {POINTS} select * from points")
def _(t):
    return R.ranking_points(t.txn, "is_fraud", "score")


@query("ranking_metrics", "E07 E08 W03", sql=f"""with {POINTS}
  select round(sum(neg / negatives * (tp - pos / 2) / positives), 6) as roc_auc,
    round(sum(pos / positives * tp / (tp + fp)), 6) as average_precision from points""")
def _(t):
    return rounded(R.rank_metrics(R.ranking_points(t.txn, "is_fraud", "score")))


@query("ranking_metrics_by_category", "E07 E08 W03", sql="""
  with p as (select category, score, sum(is_fraud) as pos, sum(1 - is_fraud) as neg from txn group by 1, 2),
  q as (select *, sum(pos) over (partition by category order by score desc) as tp,
    sum(neg) over (partition by category order by score desc) as fp,
    sum(pos) over (partition by category) as np, sum(neg) over (partition by category) as nn from p)
  select category, round(sum(case when np = 0 then 0 else neg / nn * (tp - pos / 2) / np end), 6) as roc_auc,
    round(sum(case when np = 0 then 0 else pos / np * tp / (tp + fp) end), 6) as average_precision
  from q group by category""")
def _(t):
    return rounded(R.rank_metrics(R.ranking_points(t.txn, "is_fraud", "score", ["category"]), ["category"]))


@query("roc_curve", "E09", sql=f"""with {POINTS}
  select round(fp / negatives, 6) as fpr, round(tp / positives, 6) as tpr, score as threshold from points
  union all select 0, 0, cast('inf' as double)""")
def _(t):
    out = R.roc_curve(t.txn, "is_fraud", "score")
    return out.select(r6("fpr").alias("fpr"), r6("tpr").alias("tpr"), "threshold")


@query("precision_recall_curve", "E10", sql=f"""with {POINTS}
  select round(tp / (tp + fp), 6) as precision, round(tp / positives, 6) as recall, score as threshold from points
  union all select 1, 0, cast(null as double)""")
def _(t):
    out = R.pr_curve(t.txn, "is_fraud", "score")
    return out.select(r6("precision").alias("precision"), r6("recall").alias("recall"), "threshold")


@query("f1_threshold_curve", "E11 F14", sql=f"""with {SWEEP}
  select threshold, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1 from cost""")
def _(t):
    out = T.f1_curve(t.txn, "is_fraud", "score")
    return out.select("threshold", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@query("best_f1_threshold", "E11 K06", sql=f"""with {SWEEP}
  select threshold, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1
  from cost order by cost.f1 desc, threshold limit 1""")
def _(t):
    out = T.best_by(T.f1_curve(t.txn, "is_fraud", "score"), "f1")
    return out.select("threshold", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@query("cost_threshold_curve", "E12 J05 F14", sql=f"""with {SWEEP}
  select threshold, round(fraud_loss, 4) as fraud_loss, alarm_cost, round(total_cost, 4) as total_cost,
    round(recall, 6) as recall, round(precision, 6) as precision from cost""")
def _(t):
    out = T.cost_curve(t.txn, "is_fraud", "score", F.col("amt"))
    return out.select("threshold", F.round("fraud_loss", 4).alias("fraud_loss"), "alarm_cost",
                      F.round("total_cost", 4).alias("total_cost"), r6("recall").alias("recall"),
                      r6("precision").alias("precision"))


@query("best_cost_threshold", "E12 K06 E15", sql=f"""with {SWEEP},
  loss as (select sum(case when is_fraud = 1 then amt end) as do_nothing from txn)
  select threshold, round(fraud_loss, 4) as fraud_loss, alarm_cost, round(total_cost, 4) as total_cost,
    round(recall, 6) as recall, round(precision, 6) as precision,
    round(do_nothing - total_cost, 4) as net_saving
  from cost, loss order by round(cost.total_cost, 4), threshold limit 1""")
def _(t):
    # All features are made; the projection keeps what the sweep needs.
    rows = t.features.select("is_fraud", "score", "amt")
    curve = T.cost_curve(rows, "is_fraud", "score", F.col("amt")).withColumn("total_cost", F.round("total_cost", 4))
    loss = rows.agg(F.sum(F.when(F.col("is_fraud") == 1, F.col("amt"))).alias("l")).scalar()
    return T.best_by(curve, "total_cost", "min").select(
        "threshold", F.round("fraud_loss", 4).alias("fraud_loss"), "alarm_cost", "total_cost",
        r6("recall").alias("recall"), r6("precision").alias("precision"),
        F.round(loss - F.col("total_cost"), 4).alias("net_saving"))


@query("threshold_nearest_half", "K07 E19", sql=f"""with {SWEEP}
  select threshold, round(precision, 6) as precision, round(recall, 6) as recall from cost
  order by abs(threshold - 0.5e0), threshold limit 1""")
def _(t):
    out = T.nearest_to(T.f1_curve(t.txn, "is_fraud", "score"), 0.5)
    return out.select("threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


@query("matched_recall_threshold", "E13 F14", sql=f"""with grid as ({FINE}),
  target as (select sum(case when is_fraud = 1 and score >= 0.5e0 then 1 else 0 end) / sum(is_fraud) as r from txn),
  s as (select threshold, sum(case when is_fraud = 1 and score >= threshold then 1 else 0 end) as tp,
    sum(case when is_fraud = 0 and score >= threshold then 1 else 0 end) as fp, sum(is_fraud) as p
    from grid cross join txn group by threshold)
  select threshold, round(tp / p, 6) as recall, round(case when tp + fp > 0 then tp / (tp + fp) else 0 end, 6) as precision
  from s where tp / p >= (select r from target) order by threshold desc limit 1""")
def _(t):
    curve = T.f1_curve(t.txn, "is_fraud", "score", FINE_THRESHOLDS)
    target = C.binary_report(predicted(t), "is_fraud", "pred").select("recall").scalar()
    out = T.highest_reaching(curve, target)
    return out.select("threshold", r6("recall").alias("recall"), r6("precision").alias("precision"))


@query("precision_at_recall_targets", "E14", sql=f"""with {POINTS},
  c as (select score, tp / (tp + fp) as precision, tp / positives as recall from points),
  t as (select unnest([0.95e0, 0.97e0, 0.99e0]) as target_recall),
  r as (select *, row_number() over (partition by target_recall order by precision desc, score) as rn
    from t join c on c.recall >= t.target_recall)
  select target_recall, score as threshold, round(precision, 6) as precision, round(recall, 6) as recall
  from r where rn = 1""")
def _(t):
    best = R.best_precision_at_recall(R.pr_curve(t.txn, "is_fraud", "score"), [0.95, 0.97, 0.99])
    return best.select("target_recall", "threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


@query("binary_report", "E01 E02 E03 E05 E17 P14 P15", sql="""
  with c as (select sum(case when is_fraud = 0 and score < 0.5e0 then 1 else 0 end) as tn,
    sum(case when is_fraud = 0 and score >= 0.5e0 then 1 else 0 end) as fp,
    sum(case when is_fraud = 1 and score < 0.5e0 then 1 else 0 end) as fn,
    sum(case when is_fraud = 1 and score >= 0.5e0 then 1 else 0 end) as tp from txn)
  select round((tn + tp) / (tn + fp + fn + tp), 6) as accuracy, round(tp / (tp + fp), 6) as precision,
    round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1,
    round((2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2, 6) as macro_f1,
    round(greatest(tn + fp, fn + tp) / (tn + fp + fn + tp), 6) as baseline_accuracy,
    cast(tn as bigint) as tn, cast(fp as bigint) as fp, cast(fn as bigint) as fn, cast(tp as bigint) as tp from c""")
def _(t):
    out = C.binary_report(predicted(t), "is_fraud", "pred")
    return rounded(out.select("*", "confusion_matrix.*").drop("confusion_matrix", "n_test"))


@query("operating_points", "E19 E02 P15", sql="\nunion all ".join(f"""
  select {t} as threshold, round(sum(case when is_fraud = 1 and score >= {t} then 1 else 0 end) / sum(is_fraud), 6) as recall,
    round(sum(case when is_fraud = 1 and score >= {t} then 1 else 0 end)
      / sum(case when score >= {t} then 1 else 0 end), 6) as precision,
    round(2 * sum(case when is_fraud = 1 and score >= {t} then 1 else 0 end)
      / (sum(case when score >= {t} then 1 else 0 end) + sum(is_fraud)), 6) as f1 from txn"""
    for t in ("0.19e0", "0.28e0", "0.5e0")))
def _(t):
    cuts = F.explode(F.array(*[F.lit(x) for x in (0.19, 0.28, 0.5)]))
    stacked = t.txn.select("is_fraud", "score", cuts.alias("threshold")).withColumn(
        "pred", (F.col("score") >= F.col("threshold")).cast("int"))
    out = C.binary_report(stacked, "is_fraud", "pred", ["threshold"])
    return rounded(out.select("threshold", "recall", "precision", "f1"))


REPORT = """
  labels as (select genre as label from genre union select pred from genre),
  tp as (select genre as label, count(*) as tp from genre where genre = pred group by 1),
  sup as (select genre as label, count(*) as support from genre group by 1),
  prd as (select pred as label, count(*) as predicted from genre group by 1),
  report as (select label, coalesce(tp, 0) as tp, coalesce(support, 0) as support, coalesce(predicted, 0) as predicted,
    case when coalesce(predicted, 0) > 0 then coalesce(tp, 0) / predicted else 0 end as precision,
    case when coalesce(support, 0) > 0 then coalesce(tp, 0) / support else 0 end as recall,
    2 * coalesce(tp, 0) / (coalesce(support, 0) + coalesce(predicted, 0)) as f1
    from labels left join tp using (label) left join sup using (label) left join prd using (label))"""


@query("class_report", "E04 E02", sql=f"""with {REPORT}
  select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from report""")
def _(t):
    out = C.class_report(t.genre, "genre", "pred")
    return rounded(out.select("label", "precision", "recall", "f1", "support"))


@query("full_class_report", "E04 E03", sql=f"""with {REPORT}
  select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from report
  union all select 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
    round(sum(tp) / sum(support), 6), cast(sum(support) as bigint) from report
  union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
    cast(sum(support) as bigint) from report
  union all select 'weighted avg', round(sum(precision * support) / sum(support), 6),
    round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
    cast(sum(support) as bigint) from report""")
def _(t):
    return rounded(C.full_report(C.class_report(t.genre, "genre", "pred")))


@query("multiclass_summary", "E01 E03 A28 E17", sql=f"""with {REPORT}
  select round(sum(tp) / sum(support), 6) as accuracy, round(avg(f1), 6) as macro_f1,
    round(sum(f1 * support) / sum(support), 6) as weighted_f1,
    cast(sum(case when predicted > 0 then 1 else 0 end) as bigint) as classes_predicted,
    (select count(*) from genre where genre = 'en') / cast(sum(support) as double) as baseline from report""")
def _(t):
    totals = C.report_totals(C.class_report(t.genre, "genre", "pred"))
    base = t.genre.agg(F.avg((F.col("genre") == "en").cast("double")).alias("b")).scalar()
    return totals.select(r6("accuracy").alias("accuracy"), r6("macro_f1").alias("macro_f1"),
                         r6("weighted_f1").alias("weighted_f1"), "classes_predicted", base.alias("baseline"))


@query("worst_and_best_classes", "K02 P17", sql=f"""with {REPORT},
  w as (select *, row_number() over (order by f1, label) as a, row_number() over (order by f1 desc, label) as b from report)
  select 'worst' as side, label, round(f1, 6) as f1, case when f1 < 0.3 then 'broken' when f1 < 0.5 then 'weak'
    else 'usable' end as band from w where a <= 2
  union all select 'best', label, round(f1, 6), case when f1 < 0.3 then 'broken' when f1 < 0.5 then 'weak'
    else 'usable' end from w where b <= 2""")
def _(t):
    report = C.class_report(t.genre, "genre", "pred").withColumn("band", f1_band(F.col("f1")))
    worst = report.orderBy("f1", "label").limit(2).select(F.lit("worst").alias("side"), "label", r6("f1").alias("f1"), "band")
    best = report.orderBy(F.desc("f1"), "label").limit(2).select(F.lit("best").alias("side"), "label", r6("f1").alias("f1"), "band")
    return worst.unionByName(best)


CELLS = """cells as (select genre as "true", pred as predicted, count(*) as n,
    count(*) / sum(count(*)) over (partition by genre) as share from genre group by 1, 2)"""


@query("confusion_cells", "E05 E06 W04 P18", sql=f"""with {CELLS}
  select "true", predicted, n, round(share, 6) as share,
    case when share >= 0.05e0 then round(share, 2) end as shown from cells""")
def _(t):
    cells = C.confusion_cells(t.genre, "genre", "pred")
    return cells.select("true", "predicted", "n", r6("share").alias("share"), blank_small(F.col("share")).alias("shown"))


@query("confusion_matrix_wide", "E05", sql="""
  select genre as "true", count(*) filter (pred = 'en') as en, count(*) filter (pred = 'fr') as fr,
    count(*) filter (pred = 'de') as de, count(*) filter (pred = 'es') as es from genre group by genre""")
def _(t):
    return C.confusion_matrix(t.genre, "genre", "pred", ["en", "fr", "de", "es"])


@query("top_confusions", "K03 I06 U03 E06", sql=f"""with {CELLS}
  select "true", predicted, round(share, 6) as share from cells where "true" <> predicted
  order by cells.share desc, "true", predicted limit 15""")
def _(t):
    top = C.top_confusions(C.confusion_cells(t.genre, "genre", "pred"), 15)
    return top.select("true", "predicted", r6("share").alias("share"))


@query("class_size_against_f1", "I07 A20 E04", sql=f"""with {REPORT},
  k as (select rank() over (order by support) + (count(*) over (partition by support) - 1) / 2.0e0 as a,
    rank() over (order by round(f1, 9)) + (count(*) over (partition by round(f1, 9)) - 1) / 2.0e0 as b from report)
  select count(*) as n, round(corr(a, b), 6) as spearman from k""")
def _(t):
    report = C.class_report(t.genre, "genre", "pred").withColumn("f1", F.round("f1", 9))
    return rounded(spearman(report, "support", "f1"))


@query("money_summary", "E15 A26", sql="""
  with c as (select sum(case when is_fraud = 1 then amt else 0 end) as do_nothing_loss,
    sum(case when is_fraud = 1 and score < 0.5e0 then amt else 0 end) as missed_value,
    cast(sum(case when is_fraud = 0 and score >= 0.5e0 then 1 else 0 end) as bigint) as false_alarms,
    cast(sum(case when is_fraud = 1 and score >= 0.5e0 then 1 else 0 end) as bigint) as caught,
    cast(sum(case when is_fraud = 1 and score < 0.5e0 then 1 else 0 end) as bigint) as missed,
    sum(1 - is_fraud) as legitimate from txn)
  select round(do_nothing_loss, 4) as do_nothing_loss, round(missed_value, 4) as missed_value, false_alarms, caught,
    missed, round(missed_value + 5.0e0 * false_alarms, 4) as total_cost,
    round(do_nothing_loss - (missed_value + 5.0e0 * false_alarms), 4) as net_saving,
    round(caught / (caught + missed), 4) as catch_rate, round(missed / (caught + missed), 4) as miss_rate,
    round(false_alarms / legitimate, 4) as alarm_rate, round(false_alarms / caught, 4) as alarms_per_catch from c""")
def _(t):
    return rounded(C.money_summary(predicted(t), "is_fraud", "pred", "amt"), 4)


@query("metric_disagreement", "E16 J05", sql="""
  with s as (select 'score' as model, is_fraud, score as p from txn
    union all select 'amount', is_fraud, least(1.0e0, amt / 500.0e0) from txn
    union all select 'mixed', is_fraud, 0.5e0 * score + 0.5e0 * least(1.0e0, amt / 500.0e0) from txn),
  p as (select model, p, sum(is_fraud) as pos, sum(1 - is_fraud) as neg from s group by 1, 2),
  q as (select *, sum(pos) over (partition by model order by p desc) as tp,
    sum(neg) over (partition by model order by p desc) as fp,
    sum(pos) over (partition by model) as np, sum(neg) over (partition by model) as nn from p),
  m as (select model, round(sum(neg / nn * (tp - pos / 2) / np), 6) as roc_auc,
    round(sum(pos / np * tp / (tp + fp)), 6) as average_precision from q group by model),
  k as (select *, cast(row_number() over (order by roc_auc desc, model) as int) as rank_a,
    cast(row_number() over (order by average_precision desc, model) as int) as rank_b from m)
  select *, rank_a = rank_b as same_rank from k""")
def _(t):
    amount = F.least(F.lit(1.0), F.col("amt") / 500.0)
    models = F.explode(F.array(
        F.struct(F.lit("score").alias("model"), F.col("score").alias("p")),
        F.struct(F.lit("amount").alias("model"), amount.alias("p")),
        F.struct(F.lit("mixed").alias("model"), (0.5 * F.col("score") + 0.5 * amount).alias("p"))))
    stacked = t.txn.select("is_fraud", models.alias("m")).select("is_fraud", "m.*")
    metrics = rounded(R.rank_metrics(R.ranking_points(stacked, "is_fraud", "p", ["model"]), ["model"]))
    return R.order_disagreement(metrics, "model", "roc_auc", "average_precision")


@query("alarms_per_hit", "E16 E02", sql="""
  with c as (select category, count(*) filter (is_fraud = 1 and score >= 0.4) as tp, count(*) filter (score >= 0.4) as alarms
    from txn group by 1)
  select category, round(case when alarms > 0 then tp / alarms else 0 end, 6) as "precision",
    case when tp > 0 then round(alarms / tp, 6) end as alarms_per_hit from c""")
def _(t):
    """Precision of each category at a cut of 0.4, and the alarms raised for each case caught."""
    decided = t.txn.select("category", "is_fraud", at_least(F.col("score"), 0.4).alias("pred"))
    found = C.binary_report(decided, "is_fraud", "pred", ["category"])
    return found.select("category", r6("precision").alias("precision"), r6(alarms_per_hit(F.col("precision"))).alias("alarms_per_hit"))


@query("error_listing", "P13 I08 F12", sql="""
  select case when is_fraud = 1 then 'missed' else 'false alarm' end as error, row_id, score,
    case when length(category) > 4 then concat(left(category, 4), '...') else category end as shown
  from txn where (is_fraud = 1 and score < 0.5e0) or (is_fraud = 0 and score >= 0.5e0)""")
def _(t):
    rows = predicted(t).withColumn("shown", shorten(F.col("category"), 4))
    return C.errors(rows, "is_fraud", "pred", ["row_id", "score", "shown"])


@query("reliability_table", "N05", sql="""
  select cast(least(floor(score * 10), 9) as int) as bin, count(*) as n, round(avg(score), 6) as mean_p,
    round(avg(cast(is_fraud as double)), 6) as rate from txn group by 1""")
def _(t):
    return rounded(reliability(t.txn, "is_fraud", F.col("score"), 10))


MULTI = """m as (select l.doc_id, list_filter([case when quality = 1 then 'quality' end, case when toxic = 1 then 'toxic' end,
      d.lang], lambda x: x is not null) as t,
    list_filter([case when length(d.text) > 500 then 'quality' end, case when d.n_chars % 2 = 0 then 'toxic' end,
      case when length(d.text) < 300 then 'en' else d.lang end], lambda x: x is not null) as p
    from labels l join documents d using (doc_id))"""


def multilabelled(t) -> DataFrame:
    joined = t.read("labels").join(t.read("documents"), "doc_id")
    long = F.length("text")
    return joined.select(
        F.filter(F.array(F.when(F.col("quality") == 1, "quality"), F.when(F.col("toxic") == 1, "toxic"),
                         F.col("lang")), lambda x: x.isNotNull()).alias("t"),
        F.filter(F.array(F.when(long > 500, "quality"), F.when(F.col("n_chars") % 2 == 0, "toxic"),
                         F.when(long < 300, "en").otherwise(F.col("lang"))), lambda x: x.isNotNull()).alias("p"))


@query("multilabel_scores", "N08", sql=f"""with {MULTI},
  l as (select unnest(list_distinct(list_concat(t, p))) as label, t, p from m),
  s as (select label, sum(cast(list_contains(t, label) and list_contains(p, label) as int)) as tp,
    sum(cast(list_contains(t, label) as int)) as support, sum(cast(list_contains(p, label) as int)) as predicted
    from l group by 1)
  select label, round(case when predicted > 0 then tp / predicted else 0 end, 6) as precision,
    round(case when support > 0 then tp / support else 0 end, 6) as recall,
    round(2 * tp / (support + predicted), 6) as f1, cast(support as bigint) as support from s""")
def _(t):
    return rounded(label_scores(multilabelled(t), "t", "p"))


@query("multilabel_subset_accuracy", "N08", sql=f"""with {MULTI}
  select round(avg(case when list_sort(t) = list_sort(p) then 1.0e0 else 0.0e0 end), 6) as subset_accuracy,
    count(*) as n from m""")
def _(t):
    return rounded(subset_accuracy(multilabelled(t), "t", "p"))


@query("coarser_labels_report", "N09 E04", sql="""
  with g as (select case when genre in ('en', 'de') then 'germanic' else 'romance' end as genre,
    case when pred in ('en', 'de') then 'germanic' else 'romance' end as pred from documents_view)
  select genre as label, round(avg(case when genre = pred then 1.0e0 else 0.0e0 end), 6) as recall, count(*) as support
  from g group by 1""".replace("documents_view", "genre"))
def _(t):
    # The mapping is read off the data: one row per language.
    family = F.when(F.col("genre").isin("en", "de"), "germanic").otherwise("romance")
    mapping = t.genre.select("genre").distinct().select(F.col("genre").alias("fine"), family.alias("family"))
    mapped = coarser(coarser(t.genre.select("genre", "pred"), "genre", mapping, "fine", "family"),
                     "pred", mapping, "fine", "family")
    out = C.class_report(mapped, "genre", "pred")
    return out.select("label", r6("recall").alias("recall"), "support")


@query("winner_by_metric", "K05 K01", sql="""
  select category, round(avg(score), 6) as mean_score from txn group by category
  order by mean_score desc, category limit 1""")
def _(t):
    means = t.txn.groupBy("category").agg(r6(F.avg("score")).alias("mean_score"))
    return means.orderBy(F.desc("mean_score"), "category").limit(1)
