"""Leakage, identity and faithfulness checks; splits, samples, weights and encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lopside.operators import overlap as O
from lopside.operators import splits as S
from lopside.operators.encode import categories, dummies, standardise
from lopside.operators.explain import faithfulness
from lopside.operators.profile import rate_persistence
from lopside.operators.sorted_passes import spearman
from lopside.queries.registry import query, r6, rounded

KEY = "md5(concat('42:', cast({c} as varchar)))"
FLAGGED = f"""flagged as (select *, row_number() over (partition by label order by {KEY.format(c='row_id')})
    <= round(0.2e0 * count(*) over (partition by label)) as in_test from sms)"""


@query("stratified_split", "L03 W06", sql=f"with {FLAGGED} select row_id, label, in_test from flagged")
def _(t):
    return S.with_test_flag(t.sms.select("row_id", "label"), "label", "row_id", 0.2)


@query("stratified_folds", "L04 W06", sql=f"""
  with r as (select row_id, label, row_number() over (partition by label order by {KEY.format(c='row_id')}) as rn,
    count(*) over (partition by label) as n from sms)
  select row_id, label, cast((rn > floor(n * 1 / 5)) as int) + cast((rn > floor(n * 2 / 5)) as int)
    + cast((rn > floor(n * 3 / 5)) as int) + cast((rn > floor(n * 4 / 5)) as int) as fold from r""")
def _(t):
    return S.with_fold(t.sms.select("row_id", "label"), "label", "row_id", 5)


@query("fixed_size_sample", "L05 J04", sql=f"""
  select row_id, is_fraud, amt from txn order by {KEY.format(c='row_id')} limit 600""")
def _(t):
    return S.fixed_sample(t.txn, "row_id", 600).select("row_id", "is_fraud", "amt")


@query("class_weights", "C06 C07", sql="""
  select genre, count(*) as n, round(sum(count(*)) over () / (count(*) over () * count(*)), 6) as weight
  from genre group by genre""")
def _(t):
    return rounded(S.class_weights(t.genre, "genre"))


@query("weighted_rows", "J08 C06 C07", sql="""
  with w as (select Exited, sum(count(*)) over () / (count(*) over () * count(*)) as weight from churn group by 1)
  select CustomerId, churn.Exited, round(weight, 6) as weight from churn join w on churn.Exited = w.Exited""")
def _(t):
    return rounded(S.with_class_weight(t.churn.select("CustomerId", "Exited"), "Exited"))


@query("one_hot_columns", "C02 P14", sql="""
  select CustomerId, cast(Gender = 'Male' as int) * 1.0e0 as "Gender_Male",
    cast(Geography = 'AMERICA' as int) * 1.0e0 as "Geography_AMERICA", cast(Geography = 'ASIA' as int) * 1.0e0 as "Geography_ASIA",
    cast(Geography = 'EUROPE' as int) * 1.0e0 as "Geography_EUROPE",
    cast(Geography = 'MIDDLE EAST' as int) * 1.0e0 as "Geography_MIDDLE_EAST" from churn""")
def _(t):
    found = categories(t.churn, ["Geography", "Gender"])
    out = t.churn.select("CustomerId", *dummies("Gender", found["Gender"]), *dummies("Geography", found["Geography"]))
    return out.toDF(*[c.replace(" ", "_") for c in out.columns])


@query("standardised_columns", "C03", sql="""
  with m as (select avg(Age) as ma, stddev_pop(Age) as sa, avg(Balance) as mb, stddev_pop(Balance) as sb from churn)
  select CustomerId, round((Age - ma) / sa, 6) + 0 as Age, round((Balance - mb) / sb, 6) + 0 as Balance from churn, m""")
def _(t):
    out = standardise(t.churn.select("CustomerId", "Age", "Balance"), ["Age", "Balance"])
    return out.select("CustomerId", (r6("Age") + 0).alias("Age"), (r6("Balance") + 0).alias("Balance"))


@query("rows_aligned", "J03", sql="""
  select count(case when s.row_id is not null and g.id is not null then 1 end) as matched,
    count(case when s.row_id is null then 1 end) as only_left, count(case when g.id is null then 1 end) as only_right,
    count(case when s.row_id is not null and g.id is not null and g.description is distinct from s.message then 1 end)
      as differ_description
  from genre g full outer join sms s on g.id = s.row_id""")
def _(t):
    labelled = t.sms.select(F.col("row_id").alias("id"), F.col("message").alias("description"))
    return O.alignment_report(t.genre, labelled, "id", ["description"])


@query("text_leak_without_dedup", "I05 J02 U02 L03", sql=f"""with {FLAGGED},
  a as (select distinct message from flagged where not in_test), b as (select message from flagged where in_test)
  select (select count(*) from a) as distinct_a, (select count(distinct message) from b) as distinct_b,
    (select count(distinct message) from b where message in (select message from a)) as shared,
    (select count(*) from b where message in (select message from a)) as shared_rows_b,
    (select count(*) from b) as rows_b,
    round((select count(distinct message) from b where message in (select message from a)) / (select count(*) from b), 6)
      as shared_share_of_b""")
def _(t):
    flagged = S.with_test_flag(t.sms, "label", "row_id", 0.2)
    return rounded(O.key_overlap(flagged.filter("not in_test"), flagged.filter("in_test"), "message", long_text=True))


@query("shared_cards", "J02 U02 A02", sql="""
  select count(*) as cards from (select distinct cc_num from txn_train intersect select distinct cc_num from txn_test)""")
def _(t):
    return O.shared_values(*t.txn_parts, "cc_num").agg(F.count("*").alias("cards"))


@query("card_rate_persistence", "J01 P19 A06 P06", sql="""
  with a as (select cc_num, avg(cast(is_fraud as double)) as train_rate from txn_train group by 1),
  b as (select cc_num, avg(cast(is_fraud as double)) as test_rate from txn_test group by 1)
  select cc_num, round(train_rate, 6) as train_rate, round(test_rate, 6) as test_rate from a join b using (cc_num)""")
def _(t):
    return rounded(rate_persistence(*t.txn_parts, "cc_num", "is_fraud"))


@query("identity_audit", "I04 J01 A20 W02", sql="""
  with a as (select cc_num, avg(cast(is_fraud as double)) as x from txn_train group by 1),
  b as (select cc_num, avg(cast(is_fraud as double)) as y from txn_test group by 1),
  r as (select rank() over (order by round(x, 9)) + (count(*) over (partition by round(x, 9)) - 1) / 2.0e0 as rx,
    rank() over (order by round(y, 9)) + (count(*) over (partition by round(y, 9)) - 1) / 2.0e0 as ry
    from a join b using (cc_num))
  select count(*) as n, round(corr(rx, ry), 6) as spearman from r""")
def _(t):
    train, test = t.txn_parts
    rates = rate_persistence(train, test, "cc_num", "is_fraud")
    return rounded(spearman(rates.withColumns({c: F.round(c, 9) for c in ("train_rate", "test_rate")}),
                            "train_rate", "test_rate"))


@query("hour_window_faithfulness", "I03 A29 J06 W07 P10 P20", sql="""
  with band as (select * from feat where amt between 20 and 60),
  probe as (select * from band order by row_id limit 200),
  swept as (select p.score, cast(h.hour as int) as at_hour, case when h.hour in (22, 23, 0, 1, 2, 3) then 1 else 0 end as night
    from probe p cross join (select unnest(range(24)) as hour) h),
  model as (select at_hour as hour, avg(score * 0.8e0 + 0.1e0 * night + at_hour / 1000.0e0) as p from swept group by 1),
  data as (select hour, avg(cast(is_fraud as double)) as rate from band group by 1),
  w as (select unnest([0, 4, 12, 22]) as a, unnest([3, 11, 21, 23]) as b,
    unnest(['00:00-03:59', '04:00-11:59', '12:00-21:59', '22:00-23:59']) as "window"),
  f as (select "window", (select avg(p) from model where hour between a and b) as model_says,
    (select avg(rate) from data where hour between a and b) as data_says from w),
  k as (select *, row_number() over (order by model_says desc, "window") as mr,
    row_number() over (order by data_says desc nulls last, "window") as dr from f)
  select "window", round(model_says, 6) as model_says, round(data_says, 6) as data_says,
    round(model_says - data_says, 6) as gap, cast(mr as int) as model_rank, cast(dr as int) as data_rank,
    mr = dr as same_rank, (bool_and(mr = dr) over ()) as same_order from k""")
def _(t):
    band = t.features.filter(F.col("amt").between(20, 60))
    probe = band.orderBy("row_id").limit(200)

    def score(df):
        return df.withColumn("p", F.col("score") * 0.8 + 0.1 * F.col("is_night") + F.col("hour") / 1000.0)

    return rounded(faithfulness(probe, band, score, "is_fraud"))
