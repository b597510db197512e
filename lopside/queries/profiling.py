"""Profiles of whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lopside.functions.numbers import right_closed_band
from lopside.functions.text import word_count
from lopside.operators import profile as P
from lopside.operators.sorted_passes import average_ranks, spearman
from lopside.queries.registry import query, r6, rounded
from lopside.sources.standins import CHURN_CATEGORICAL, CHURN_NUMERIC

CHURN_COLUMNS = [*CHURN_NUMERIC, "Exited"]


def union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@query("table_sizes", "A01 K08", sql="""
  select 'transactions' as name, count(*) as n_rows, 14 as n_columns from txn
  union all select 'churn', count(*), 13 from churn
  union all select 'genre', count(*), 6 from genre
  union all select 'sms', count(*), 3 from sms""")
def _(t):
    named = {"transactions": t.txn, "churn": t.churn, "genre": t.genre, "sms": t.sms}
    return union(P.table_size(df).select(F.lit(n).alias("name"), "n_rows", F.col("n_columns").cast("int").alias("n_columns"))
                 for n, df in named.items())


@query("distinct_values", "A02", sql="""
  select 'cc_num' as "column", count(distinct cc_num) as n_distinct from txn
  union all select 'category', count(distinct category) from txn
  union all select 'gender', count(distinct gender) from txn
  union all select 'amt', count(distinct amt) from txn""")
def _(t):
    return P.distinct_counts(t.txn, ["cc_num", "category", "gender", "amt"])


@query("identifying_combinations", "A03 I04", sql="""
  select (select count(*) from (select distinct dob, gender, city_pop from txn)) as combinations,
    (select count(distinct cc_num) from txn) as cards""")
def _(t):
    return P.distinct_combinations(t.txn, ["dob", "gender", "city_pop"]).select(
        F.col("n_groups").alias("combinations"),
        t.txn.agg(F.countDistinct("cc_num").alias("c")).scalar().alias("cards"))


@query("genre_counts", "A04 K01 E17", sql="""
  select genre, count(*) as n, round(count(*) / (select count(*) from genre), 6) as share
  from genre group by genre order by n desc, genre""")
def _(t):
    return rounded(P.value_counts(t.genre, "genre"))


@query("churn_counts_named", "A04 P06", sql="""
  select case when Exited = 1 then 'churned' else 'stayed' end as outcome, count(*) as customers
  from churn group by 1""")
def _(t):
    named = t.churn.withColumn("outcome", F.when(F.col("Exited") == 1, "churned").otherwise("stayed"))
    return P.value_counts(named, "outcome").drop("share").withColumnRenamed("n", "customers")


@query("imbalance_summary", "A05 E17", sql="""
  with c as (select genre as c, count(*) as n from genre group by 1),
  r as (select *, row_number() over (order by n desc, c) as i, count(*) over () as k, sum(n) over () as total from c)
  select max(k) as n_classes, max(case when i = 1 then c end) as largest, max(case when i = 1 then n end) as n_largest,
    max(case when i = k then c end) as smallest, max(case when i = k then n end) as n_smallest,
    round(max(case when i = 1 then n end) / max(case when i = k then n end), 6) as ratio,
    round(sum(case when i <= 2 then n end) / max(total), 6) as top2_share,
    round(max(case when i = 1 then n end) / max(total), 6) as baseline_accuracy from r""")
def _(t):
    return rounded(P.imbalance(t.genre, "genre"))


@query("fraud_rate_by_category", "A06 A08", sql="""
  select category, count(*) as transactions, round(avg(cast(is_fraud as double)) * 100, 6) as fraud_rate
  from txn group by category order by fraud_rate desc, category""")
def _(t):
    return (P.rate_by(t.txn, "category", "is_fraud").select(
        "category", F.col("n").alias("transactions"), r6(F.col("rate") * 100).alias("fraud_rate"))
        .orderBy(F.desc("fraud_rate"), "category"))


@query("category_class_medians", "A09 J07", sql="""
  with m as (select category, quantile_cont(case when is_fraud = 0 then amt end, 0.5) as legitimate,
      quantile_cont(case when is_fraud = 1 then amt end, 0.5) as fraud,
      avg(cast(is_fraud as double)) as rate from txn group by category)
  select category, round(legitimate, 6) as legitimate, round(fraud, 6) as fraud,
    cast(row_number() over (order by round(rate, 9), category) as int) as position from m""")
def _(t):
    medians = P.medians_wide(t.txn, "amt", "category", "is_fraud", {0: "legitimate", 1: "fraud"})
    # One row per category: the order is a window over that small table.
    from pyspark.sql import Window
    rates = P.rate_by(t.txn, "category", "is_fraud")
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.round("rate", 9), "category"))
    return rounded(medians.join(rates.select("category", place.alias("position")), "category"))


DESCRIBE = """count({c}) as count, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
    round(cast(min({c}) as double), 6) as min, round(quantile_cont({c}, 0.25), 6) as q25,
    round(quantile_cont({c}, 0.5), 6) as q50, round(quantile_cont({c}, 0.75), 6) as q75,
    round(cast(max({c}) as double), 6) as max"""
WORDS = r"len(list_filter(regexp_split_to_array({c}, '\s+'), lambda x: x <> ''))"


@query("text_length_profile", "A10 F04 F05 P07", sql=f"""
  with m as (select length(description) as n_chars, {WORDS.format(c='description')} as n_words from genre)
  select 'n_chars' as "column", {DESCRIBE.format(c='n_chars')} from m
  union all select 'n_words', {DESCRIBE.format(c='n_words')} from m""")
def _(t):
    measured = t.genre.select(F.length("description").alias("n_chars"),
                              word_count(F.col("description")).alias("n_words"))
    return rounded(P.describe(measured, ["n_chars", "n_words"]))


@query("message_length_by_class", "A11", sql=f"""
  with m as (select label, length(message) as length, {WORDS.format(c='message')} as n_words from sms)
  select label, 'length' as "column", {DESCRIBE.format(c='length')} from m group by label
  union all select label, 'n_words', {DESCRIBE.format(c='n_words')} from m group by label""")
def _(t):
    measured = t.sms.select("label", F.length("message").alias("length"),
                            word_count(F.col("message")).alias("n_words"))
    return rounded(P.describe(measured, ["length", "n_words"], ["label"]))


@query("amount_and_distance_by_class", "A11 P06", sql=f"""
  select case when is_fraud = 1 then 'fraud' else 'legitimate' end as class, 'amt' as "column",
    {DESCRIBE.format(c='amt')} from feat group by 1
  union all
  select case when is_fraud = 1 then 'fraud' else 'legitimate' end, 'distance_km',
    {DESCRIBE.format(c='distance_km')} from feat group by 1""")
def _(t):
    named = t.features.withColumn("class", F.when(F.col("is_fraud") == 1, "fraud").otherwise("legitimate"))
    return rounded(P.describe(named, ["amt", "distance_km"], ["class"]))


@query("time_bounds", "A12", sql="""
  select strftime(min(trans_date_trans_time), '%Y-%m-%d %H:%M:%S') as first_at,
    strftime(max(trans_date_trans_time), '%Y-%m-%d %H:%M:%S') as last_at from txn""")
def _(t):
    at, text = "trans_date_trans_time", "yyyy-MM-dd HH:mm:ss"
    return t.txn.agg(F.date_format(F.min(at), text).alias("first_at"), F.date_format(F.max(at), text).alias("last_at"))


@query("missing_values", "A13", sql="""
  select (select 13 * count(*) - count(CustomerId) - count(Surname) - count(CreditScore) - count(Geography) - count(Gender)
        - count(Age) - count(Tenure) - count(Balance) - count(NumOfProducts) - count(HasCrCard) - count(IsActiveMember)
        - count(EstimatedSalary) - count(Exited) from churn) as in_churn,
    (select 7 * count(*) - count(doc_id) - count(text) - count(lang) - count(source) - count(n_chars) - count(quality)
        - count(toxic) from documents left join labels using (doc_id)) as in_labelled_documents""")
def _(t):
    churn = P.null_counts(t.churn)
    joined = t.read("documents").join(t.read("labels"), "doc_id", "left")
    return churn.select(F.col("total_missing").alias("in_churn"),
                        P.null_counts(joined).select("total_missing").scalar().alias("in_labelled_documents"))


@query("duplicate_rows", "A14", sql="""
  select 'sms.message' as name, count(*) as n_rows, count(distinct message) as n_distinct,
    count(*) - count(distinct message) as n_duplicates from sms
  union all
  select 'genre.description', count(*), count(distinct description), count(*) - count(distinct description) from genre
  union all
  select 'txn without row id', count(*), (select count(*) from (select distinct * exclude (row_id) from txn)),
    count(*) - (select count(*) from (select distinct * exclude (row_id) from txn)) from txn
  union all
  select 'events by kind', count(*), (select count(*) from (select distinct user_id, event_type from events)),
    count(*) - (select count(*) from (select distinct user_id, event_type from events)) from events""")
def _(t):
    return union(P.duplicate_count(df, cols).select(F.lit(n).alias("name"), "*") for n, df, cols in (
        ("sms.message", t.sms, ["message"]), ("genre.description", t.genre, ["description"]),
        ("txn without row id", t.txn, [c for c in t.txn.columns if c != "row_id"]),
        ("events by kind", t.read("events"), ["user_id", "event_type"])))


@query("duplicates_by_class", "A15", sql="""
  select label, count(*) as n_duplicates from (
    select label, row_number() over (partition by message order by row_id) as rn from sms) where rn > 1
  group by label""")
def _(t):
    return P.duplicates_by_class(t.sms, "message", "label", "row_id")


@query("conflicting_labels", "A16", sql="""
  select md5(message) as key, count(distinct label) as n_labels from sms group by message having count(distinct label) > 1
  union all
  select md5(cast(cc_num as varchar)), count(distinct category) from txn group by cc_num
    having count(distinct category) > 1""")
def _(t):
    messages = P.conflicting_labels(t.sms, "message", "label").select(F.md5("message").alias("key"), "n_labels")
    cards = t.txn.select(F.col("cc_num").cast("string").alias("card"), "category")
    return messages.unionByName(P.conflicting_labels(cards, "card", "category").select(F.md5("card").alias("key"), "n_labels"))


@query("first_messages", "W01", sql="select row_id, label, md5(message) as message_md5 from sms_unique")
def _(t):
    return t.sms_unique.select("row_id", "label", F.md5("message").alias("message_md5"))


def _corr_sql() -> str:
    return "\nunion all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr(cast({a} as double), cast({b} as double)), 6) + 0 as corr from churn"
        for a in CHURN_COLUMNS for b in CHURN_COLUMNS)


@query("correlation_matrix", "A19 P05", sql=_corr_sql())
def _(t):
    numeric = [c for c in P.numeric_columns(t.churn) if c != "CustomerId"]
    return P.correlations(t.churn, numeric).withColumn("corr", r6("corr") + 0)


@query("correlation_with_target", "A19 F11 K01", sql="\nunion all ".join(
    f"""select '{a}' as "column", round(abs(corr(cast({a} as double), cast(Exited as double))), 6) as abs_corr from churn"""
    for a in CHURN_NUMERIC))
def _(t):
    return rounded(P.ranked_correlations(t.churn, "Exited", CHURN_NUMERIC))


@query("word_count_ranks", "W02", sql=f"""
  with m as (select {WORDS.format(c='description')} as n_words from genre),
  r as (select n_words, rank() over (order by n_words) as r, count(*) over (partition by n_words) as c from m)
  select distinct cast(n_words as int) as n_words, c as n, r + (c - 1) / 2.0e0 as avg_rank from r""")
def _(t):
    return average_ranks(t.genre.select(word_count(F.col("description")).alias("n_words")), "n_words")


@query("length_words_spearman", "A20 W02", sql=f"""
  with m as (select length(description) as a, {WORDS.format(c='description')} as b from genre),
  r as (select rank() over (order by a) + (count(*) over (partition by a) - 1) / 2.0e0 as ra,
     rank() over (order by b) + (count(*) over (partition by b) - 1) / 2.0e0 as rb from m)
  select count(*) as n, round(corr(ra, rb), 6) as spearman from r""")
def _(t):
    measured = t.genre.select(F.length("description").alias("a"), word_count(F.col("description")).alias("b"))
    return rounded(spearman(measured, "a", "b"))


@query("word_count_histogram", "A21 S16", sql=f"""
  with m as (select cast({WORDS.format(c='description')} as double) as v from genre),
  s as (select min(v) as lo, (max(v) - min(v)) / 70 as w from m)
  select cast(least(floor((v - lo) / w), 69) as int) as bin, count(*) as n,
    round(min(lo) + cast(least(floor((v - lo) / w), 69) as int) * min(w), 6) as left_edge
  from m cross join s group by 1, cast(least(floor((v - lo) / w), 69) as int)""")
def _(t):
    return rounded(P.histogram(t.genre.select(word_count(F.col("description")).alias("w")), "w", 70))


@query("message_length_density", "A21 S16", sql="""
  with m as (select label, cast(length(message) as double) as v from sms),
  s as (select min(v) as lo, (max(v) - min(v)) / 60 as w from m),
  h as (select label, cast(least(floor((v - lo) / w), 59) as int) as bin, count(*) as n, min(lo) as lo, min(w) as w
    from m cross join s group by 1, 2)
  select label, bin, n, round(lo + bin * w, 6) as left_edge,
    round(n / (sum(n) over (partition by label) * w), 9) as density from h""")
def _(t):
    out = P.histogram(t.sms.select("label", F.length("message").alias("v")), "v", 60, "label")
    return out.withColumn("left_edge", r6("left_edge")).withColumn("density", F.round("density", 9))


@query("churn_defaults", "A22 S14", sql="""
  select "column", median, mode from (
  """ + "\nunion all ".join(
    f"""select '{c}' as "column", round(quantile_cont(cast({c} as double), 0.5), 6) as median, cast(null as varchar) as mode from churn"""
    for c in CHURN_NUMERIC) + "\nunion all " + "\nunion all ".join(
    f"""select '{c}', null, (select {c} from churn group by {c} order by count(*) desc, {c} limit 1)"""
    for c in CHURN_CATEGORICAL) + ")")
def _(t):
    return rounded(P.dataset_defaults(t.churn, CHURN_NUMERIC, CHURN_CATEGORICAL))


@query("filled_customers", "S14 A22", sql="""
  with d as (select quantile_cont(Age, 0.5) as d_age, quantile_cont(Balance, 0.5) as d_balance,
    (select Geography from churn group by Geography order by count(*) desc, Geography limit 1) as geo from churn)
  select CustomerId, coalesce(case when HasCrCard = 1 then Age end, cast(trunc(d.d_age) as bigint)) as Age,
    round(coalesce(case when HasCrCard = 1 then Balance end, d.d_balance), 6) as Balance,
    coalesce(case when IsActiveMember = 1 then Geography end, d.geo) as Geography
  from churn cross join d""")
def _(t):
    defaults = P.dataset_defaults(t.churn, ["Age", "Balance"], ["Geography"])
    holes = t.churn.select(
        "CustomerId", F.when(F.col("HasCrCard") == 1, F.col("Age")).alias("Age"),
        F.when(F.col("HasCrCard") == 1, F.col("Balance")).alias("Balance"),
        F.when(F.col("IsActiveMember") == 1, F.col("Geography")).alias("Geography"))
    return rounded(P.fill_defaults(holes, defaults, ["Age", "Balance", "Geography"]))


@query("length_box_plot_largest_sources", "A23 K09 P09 J07", sql=f"""
  with m as (select source, cast({WORDS.format(c='description')} as double) as v from genre),
  top as (select source, row_number() over (order by count(*) desc, source) as position from m group by source
    qualify position <= 8),
  q as (select source, quantile_cont(v, 0.25) as q25, quantile_cont(v, 0.5) as q50, quantile_cont(v, 0.75) as q75
    from m group by source)
  select m.source, cast(min(top.position) as int) as position, round(min(q25), 6) as q25, round(min(q50), 6) as q50,
    round(min(q75), 6) as q75,
    min(case when v >= q25 - 1.5e0 * (q75 - q25) and v <= q75 + 1.5e0 * (q75 - q25) then v end) as low_whisker,
    max(case when v >= q25 - 1.5e0 * (q75 - q25) and v <= q75 + 1.5e0 * (q75 - q25) then v end) as high_whisker,
    count(*) - count(case when v >= q25 - 1.5e0 * (q75 - q25) and v <= q75 + 1.5e0 * (q75 - q25) then 1 end) as n_outliers
  from m join top using (source) join q using (source) group by m.source""")
def _(t):
    from pyspark.sql import Window
    measured = t.genre.select("source", word_count(F.col("description")).alias("n_words"))
    top = P.top_groups(measured, "source", 8)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "source"))
    kept = measured.join(F.broadcast(top), "source", "left_semi")  # eight rows
    boxes = P.box_stats(kept, "n_words", "source")
    return rounded(boxes.join(top.select("source", place.alias("position")), "source"))


@query("log_amount_density", "A24 F10 S16", sql="""
  with v as (select is_fraud, log10(amt) as v from txn where amt > 0),
  s as (select is_fraud, count(*) as n, min(v) as lo, max(v) as hi, pow(count(*), -0.2e0) * stddev_samp(v) as h
    from v group by 1),
  c as (select v.is_fraud, cast(least(floor((v.v - lo) / ((hi - lo) / 512)), 511) as int) as cell, count(*) as m,
    min(n) as n, min(lo) as lo, min(hi) as hi, min(h) as h from v join s on v.is_fraud = s.is_fraud group by 1, 2),
  g as (select *, lo + (cell + 0.5e0) * ((hi - lo) / 512) as x, unnest(range(200)) as i from c),
  k as (select *, (lo - 3 * h) + i * ((hi - lo + 6 * h) / 199) as pos from g)
  select is_fraud, cast(i as int) as i, round(max(pos), 6) as x,
    round(sum(m * exp(-((pos - x) / h) * ((pos - x) / h) / 2)) / min(n * h) / sqrt(2 * pi()), 6) as density
  from k group by 1, 2""")
def _(t):
    amounts = t.txn.filter(F.col("amt") > 0)
    return rounded(P.density_estimate(amounts, F.log10("amt"), "is_fraud", bins=512))


@query("log_amount_density_exact", "A24 F10 S16", sql="""
  with v as (select is_fraud, log10(amt) as v from txn where amt > 0),
  s as (select is_fraud, count(*) as n, min(v) as lo, max(v) as hi, pow(count(*), -0.2e0) * stddev_samp(v) as h
    from v group by 1),
  g as (select *, unnest(range(200)) as i from s),
  k as (select is_fraud, n, h, i, (lo - 3 * h) + i * ((hi - lo + 6 * h) / 199) as pos from g)
  select k.is_fraud, cast(i as int) as i, round(max(pos), 6) as x,
    round(sum(exp(-((pos - v) / h) * ((pos - v) / h) / 2)) / min(n * h) / sqrt(2 * pi()), 6) as density
  from k join v on v.is_fraud = k.is_fraud group by 1, 2""")
def _(t):
    """The density of the rows themselves, without bins."""
    amounts = t.txn.filter(F.col("amt") > 0)
    return rounded(P.density_estimate(amounts, F.log10("amt"), "is_fraud", bins=None))


BREAKDOWN_EDGES = [17, 30, 40, 50, 60, 100]
BREAKDOWN_LABELS = ["18-30", "31-40", "41-50", "51-60", "60+"]


@query("churn_rate_breakdowns", "A06 A07 A25 F09 I10", sql="""
  with b as (select *, case when Age > 17 and Age <= 30 then '18-30' when Age > 30 and Age <= 40 then '31-40'
    when Age > 40 and Age <= 50 then '41-50' when Age > 50 and Age <= 60 then '51-60'
    when Age > 60 and Age <= 100 then '60+' end as AgeBucket from churn),
  l as (select 'Geography' as feature, Geography as value, Exited from b
    union all select 'Gender', Gender, Exited from b
    union all select 'AgeBucket', AgeBucket, Exited from b where AgeBucket is not null
    union all select 'NumOfProducts', cast(NumOfProducts as varchar), Exited from b
    union all select 'IsActiveMember', cast(IsActiveMember as varchar), Exited from b
    union all select 'Tenure', cast(Tenure as varchar), Exited from b)
  select feature, value, count(*) as n, round(avg(cast(Exited as double)), 6) as rate,
    case when count(*) < 100 then 'thin base' else 'ok' end as base from l group by 1, 2""")
def _(t):
    banded = t.churn.withColumn("AgeBucket", right_closed_band(F.col("Age"), BREAKDOWN_EDGES, BREAKDOWN_LABELS))
    features = ["Geography", "Gender", "AgeBucket", "NumOfProducts", "IsActiveMember", "Tenure"]
    # One pass for all breakdowns: each row gives one (feature, value) per feature.
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in features]))
    long = banded.select("Exited", cells.alias("c")).select("Exited", "c.*").filter("value is not null")
    return rounded(P.rate_by(long, ["feature", "value"], "Exited", thin=100))


@query("previewed_rows", "K08", sql="""
  select row_id, category, amt from txn order by row_id limit 5""")
def _(t):
    return P.preview(t.txn, "row_id", 5).select("row_id", "category", "amt")


@query("label_list", "K10", sql="""
  select string_agg(genre, ',' order by genre) as labels from (select distinct genre from genre)""")
def _(t):
    return P.sorted_labels(t.genre, "genre").select(F.array_join("labels", ",").alias("labels"))


@query("rows_for_refit", "U01 L06", sql="""
  select is_fraud, count(*) as n, round(sum(amt), 2) as amount from (
    select * from txn_train union all select * from txn_test) group by is_fraud""")
def _(t):
    train, test = t.txn_parts
    return train.unionByName(test).groupBy("is_fraud").agg(
        F.count("*").alias("n"), F.round(F.sum("amt"), 2).alias("amount"))


@query("thin_cohorts", "I10 A07", sql="""
  select NumOfProducts, count(*) as n, round(avg(cast(Exited as double)), 6) as rate,
    case when count(*) < 300 then 'thin base' else 'ok' end as base from churn group by 1""")
def _(t):
    return rounded(P.rate_by(t.churn, "NumOfProducts", "Exited", thin=300))


@query("renamed_and_dropped_columns", "P01 P04 P06", sql="""
  select c.Geography as place, count(*) as customers, round(sum(c.Balance), 2) as balance
  from churn c group by 1""")
def _(t):
    slim = t.churn.drop("CustomerId", "Surname").withColumnRenamed("Geography", "place")
    kept = [c for c in slim.columns if c not in P.columns_with_prefix(slim, "Unnamed")]
    return slim.select(*kept).groupBy("place").agg(
        F.count("*").alias("customers"), F.round(F.sum("Balance"), 2).alias("balance"))
