"""File formats: the tables are written in each format and read back by the loaders."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lopside.functions.numbers import at_least, money_text, percent_text
from lopside.operators.confusion import binary_report
from lopside.operators.profile import columns_except, columns_with_prefix, rate_by
from lopside.operators.splits import stratified_split
from lopside.plans.learners import logistic, score_tabular
from lopside.plans.training import train_churn
from lopside.queries.registry import query
from lopside.session import durable, shared_folder
from lopside.sources import readers as R
from lopside.sources import sinks
from lopside.sources.standins import CHURN_CATEGORICAL, CHURN_NUMERIC


def fresh(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


FLAT = "trim(replace(description, chr(10), ' '))"


@query("documents_from_delimited_text", "S01 S02", sql=f"""
  select id, title, genre, md5({FLAT}) as text_md5 from genre""")
def _(t):
    path = fresh(t, "genre")
    flat = F.concat(F.lit("  "), F.translate("description", "\n", " "), F.lit("\t"))
    line = F.concat_ws(" ::: ", F.col("id").cast("string"), "title", "genre", flat)
    t.genre.select(line).write.text(path)
    return R.read_delimited(t.spark, path).select("id", "title", "genre", F.md5("description").alias("text_md5"))


@query("unlabelled_documents_from_text", "S03", sql=f"select id, title, md5({FLAT}) as text_md5 from genre")
def _(t):
    path = fresh(t, "unlabelled")
    flat = F.translate("description", "\n", " ")
    t.genre.select(F.concat_ws(" ::: ", F.col("id").cast("string"), "title", flat)).write.text(path)
    out = R.read_delimited(t.spark, path, R.UNLABELLED_DOCUMENTS)
    return out.select("id", "title", F.md5("description").alias("text_md5"))


@query("transactions_from_csv", "S04 S08", sql="""
  select row_id, strftime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S') as at_text, strftime(dob, '%Y-%m-%d') as born,
    cc_num, category, amt, is_fraud from txn""")
def _(t):
    path = fresh(t, "transactions")
    raw = t.txn.select(
        F.col("row_id").alias("_"), F.date_format("trans_date_trans_time", "yyyy-MM-dd HH:mm:ss").alias("trans_date_trans_time"),
        "cc_num", "category", "amt", F.date_format("dob", "yyyy-MM-dd").alias("dob"), "is_fraud")
    raw.write.csv(path, header=True)
    df = R.read_transactions(t.spark, path)
    return df.select("row_id", F.date_format("trans_date_trans_time", "yyyy-MM-dd HH:mm:ss").alias("at_text"),
                     F.date_format("dob", "yyyy-MM-dd").alias("born"), "cc_num", "category", "amt", "is_fraud")


@query("churn_from_csv", "S05 P01 S07", sql="""
  select CreditScore, Geography, Gender, Age, Tenure, count(*) as n, cast(sum(Exited) as bigint) as exited
  from churn group by all""")
def _(t):
    path = fresh(t, "churn")
    t.churn.select(F.lit(0).alias("RowNumber"), *[f.name for f in R.CHURN.fields if f.name != "RowNumber"]).write.csv(
        path, header=True)
    df = R.read_churn(t.spark, path)
    return df.groupBy("CreditScore", "Geography", "Gender", "Age", "Tenure").agg(
        F.count("*").alias("n"), F.sum("Exited").alias("exited")).withColumns(
        {c: F.col(c).cast("bigint") for c in ("CreditScore", "Age")})


@query("messages_from_latin1_csv", "S06 F03 P04", sql="select label, md5(message) as message_md5 from sms")
def _(t):
    path = fresh(t, "sms")
    none = F.lit(None).cast("string")
    t.sms.select(F.col("label").alias("v1"), F.col("message").alias("v2"), none.alias("_c2"), none.alias("_c3")).write.csv(
        path, header=True, encoding="ISO-8859-1", quote='"', escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False)
    fixed = R.repair_overflow(R.read_messages(t.spark, path), "v2")
    return fixed.select(F.col("v1").alias("label"), F.md5("message").alias("message_md5"))


@query("messages_repaired_from_csv", "S06 F03 P04 P11", sql="""
  select label, md5(regexp_replace(regexp_replace(message, ' ', ','), ' ', ',')) as message_md5,
    cast(contains(message, ' ') as int) as was_cut from sms""")
def _(t):
    """Messages cut into two overflow columns, which are found by their prefix and joined again."""
    path = fresh(t, "sms")
    parts = F.split("message", " ", 3)
    cut = t.sms.select(F.col("label").alias("v1"), *[F.try_element_at(parts, F.lit(i + 1)).alias(c) for i, c in enumerate(("v2", "_c2", "_c3"))])
    cut.write.csv(path, header=True, encoding="ISO-8859-1", quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                  ignoreTrailingWhiteSpace=False)
    raw = R.read_messages(t.spark, path)
    overflow = columns_with_prefix(raw, "_c")
    fixed = R.repair_overflow(raw.withColumn("was_cut", F.coalesce(*overflow).isNotNull().cast("int")), "v2", overflow)
    return fixed.select(F.col("v1").alias("label"), F.md5("message").alias("message_md5"), "was_cut")


@query("required_inputs", "S07", sql=" union all ".join(
    f"select '{name}' as input, 'read' as status, count(*) as n_rows from {name}" for name in ("events", "orders", "customer", "documents", "labels"))
    + " union all select 'no_such_input', 'missing', 0")
def _(t):
    """Rows of every input that a job needs, and which of them are not there."""
    out = None
    for name in ("events", "orders", "customer", "documents", "labels", "no_such_input"):
        try:
            rows, status = R.require(lambda: t.read(name), name), "read"
        except R.InputMissing:
            rows, status = t.spark.range(0), "missing"
        rows = rows.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("input"), F.lit(status).alias("status"), "n_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("means_of_other_columns", "P03", sql="select Geography, " + ", ".join(
    f"round(avg({c}), 4) as {c}" for c in CHURN_NUMERIC) + " from churn group by 1")
def _(t):
    """Means of all columns but the identifiers, the label and the categories."""
    rest = columns_except(t.churn, ["CustomerId", "Surname", "Exited", *CHURN_CATEGORICAL])
    return t.churn.groupBy("Geography").agg(*[F.round(F.avg(c), 4).alias(c) for c in rest])


@query("hour_results_from_json", "S12 P15", sql="""
  select row_id, hour, round(score, 4) as fraud_probability, case when score >= 0.19 then 'block' else 'approve' end as decision
  from feat""")
def _(t):
    path = fresh(t, "hours")
    results = t.features.select("row_id", sinks.hour_result(F.col("score"), 0.19).alias("r")).select("row_id", "r.*")
    sinks.write_json(results, path)
    return t.spark.read.schema("row_id long, hour int, fraud_probability double, decision string").json(path)


@query("metrics_from_json", "S13 S12", sql="""
  with c as (select count(*) filter (is_fraud = 1 and score >= 0.5) as tp, count(*) filter (is_fraud = 0 and score >= 0.5) as fp,
    count(*) filter (is_fraud = 1 and score < 0.5) as fn from txn)
  select 'f1,precision,recall' as names, round(case when tp + fp > 0 then tp / (tp + fp) else 0 end, 6) as "precision",
    round(case when tp + fn > 0 then tp / (tp + fn) else 0 end, 6) as recall,
    round(case when tp > 0 then 2 * tp / (2 * tp + fp + fn) else 0 end, 6) as f1 from c""")
def _(t):
    """The metrics as they are written, without the nested matrix, and read again."""
    path = fresh(t, "metrics")
    decided = t.txn.select("is_fraud", at_least(F.col("score"), 0.5).alias("pred"))
    metrics = binary_report(decided, "is_fraud", "pred").select(
        *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "confusion_matrix")
    sinks.metrics_json(metrics).write.text(path)
    written = t.spark.read.text(path)
    parsed = F.from_json("value", "precision double, recall double, f1 double")
    return written.select(F.array_join(F.array_sort(F.json_object_keys("value")), ",").alias("names"), parsed.alias("m")).select("names", "m.*")


@query("figure_table", "S16 A08", sql="""
  select category, hour, count(*) as n, round(avg(cast(is_fraud as double)), 6) as rate from feat group by 1, 2""")
def _(t):
    """The numbers behind a heat map, written and read again."""
    path = fresh(t, "figure")
    sinks.write_table(rate_by(t.features, ["category", "hour"], "is_fraud"), path)
    return t.spark.read.parquet(path).select("category", "hour", "n", F.round("rate", 6).alias("rate"))


@query("percent_texts", "F16 A06", sql="""
  select source, n, format('{:.3f}%', 100 * rate) as share from (
    select source, count(*) as n, avg(cast(genre = 'en' as int)) as rate from genre group by 1)""")
def _(t):
    rates = rate_by(t.genre.select("source", (F.col("genre") == "en").cast("int").alias("y")), "source", "y")
    return rates.select("source", "n", percent_text(F.col("rate"), 3).alias("share"))


@query("money_texts", "F16", sql="select row_id, concat('$', format('{:,.2f}', amt)) as amount from txn")
def _(t):
    return t.txn.select("row_id", money_text(F.col("amt"), 2).alias("amount"))


def _sound_bundle(both):
    return both.select("CustomerId", (F.col("p") == F.col("fitted_p")).alias("same_as_fitted"),
                       (F.col("threshold") == F.col("fitted_threshold")).alias("threshold_kept"))


@query("scores_from_saved_bundle", "S09 S10 S13 Q04", holds=_sound_bundle)
def _(t):
    """Train, save, load again, and score the held-out customers with the loaded model."""
    folder = fresh(t, "bundle")
    churn = durable(t.churn)
    fitted = train_churn(churn, "CustomerId", "Exited", CHURN_CATEGORICAL, CHURN_NUMERIC, refit=False,
                         learner=logistic, folder=folder)
    bundle = sinks.load_bundle(t.spark, folder)
    _, test = stratified_split(churn, "Exited", "CustomerId")
    both = score_tabular(fitted.model, score_tabular(bundle.model, test, "loaded"))
    return both.select("CustomerId", F.col("loaded").alias("p"), F.lit(bundle.threshold).alias("threshold"),
                       F.col("p").alias("fitted_p"), F.lit(fitted.threshold).alias("fitted_threshold"))
