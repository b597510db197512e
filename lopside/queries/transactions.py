"""Transaction features, splits by time, bands and velocity."""

from __future__ import annotations

from pyspark.sql import functions as F

from lopside.functions.numbers import (at_least, churn_band, confidence, fraud_band,
                                       right_closed_band, right_closed_band_order, text_bar)
from lopside.functions.transactions import (FEATURES, IDENTITY_FREE, TRANSACTION_ONLY, hour_angle,
                                            hour_sweep)
from lopside.operators.history import velocity
from lopside.operators.profile import conditional_rates, load_summary, rate_by
from lopside.operators.splits import check_time_order, feature_set
from lopside.queries.registry import query, r6, rounded
from lopside.sources.readers import parse_date, parse_timestamp

AMOUNT_EDGES = [0, 10, 50, 100, 200, 500, 1000, 30000]
AGE_EDGES = [0, 30, 40, 50, 60, 70, 120]
AGE_LABELS = ["<30", "30-40", "40-50", "50-60", "60-70", "70+"]


def sql_band(column: str, edges, labels) -> str:
    cases = " ".join(f"when {column} > {a} and {column} <= {b} then {name}"
                     for a, b, name in zip(edges, edges[1:], labels))
    return f"case {cases} end"


@query("transaction_features", "C01 F06 F07 F08 F17 P07", sql="""
  select row_id, amt, category, hour, is_night, dayofweek, round(age, 6) as age, gender, city_pop,
    round(distance_km, 6) as distance_km from feat""")
def _(t):
    return rounded(t.features.select("row_id", *FEATURES))


@query("fraud_rate_by_amount_band", "F09 A25 A06 P07", sql=f"""
  select {sql_band('amt', AMOUNT_EDGES, [f"'({a}, {b}]'" for a, b in zip(AMOUNT_EDGES, AMOUNT_EDGES[1:])])} as band,
    {sql_band('amt', AMOUNT_EDGES, range(7))} as band_order,
    count(*) as n, round(avg(cast(is_fraud as double)), 6) as rate
  from txn where amt > 0 and amt <= 30000 group by 1, 2""")
def _(t):
    banded = t.txn.select("is_fraud", right_closed_band(F.col("amt"), AMOUNT_EDGES).alias("band"),
                          right_closed_band_order(F.col("amt"), AMOUNT_EDGES).alias("band_order"))
    return rounded(rate_by(banded.na.drop(subset=["band"]), ["band", "band_order"], "is_fraud"))


@query("fraud_rate_by_age_band", "F09 F07 A25", sql=f"""
  select {sql_band('age', AGE_EDGES, [f"'{x}'" for x in AGE_LABELS])} as band,
    count(*) as n, round(avg(cast(is_fraud as double)), 6) as rate
  from feat where age > 0 and age <= 120 group by 1""")
def _(t):
    banded = t.features.select("is_fraud", right_closed_band(F.col("age"), AGE_EDGES, AGE_LABELS).alias("band"))
    return rounded(rate_by(banded.na.drop(subset=["band"]), "band", "is_fraud"))


@query("log_amounts", "F10", sql="""
  select row_id, case when amt > 0 then round(log10(amt), 6) end as log_amt from txn""")
def _(t):
    return t.txn.select("row_id", F.when(F.col("amt") > 0, r6(F.log10("amt"))).alias("log_amt"))


@query("decision_bands", "P15 P16 F11", sql="""
  select row_id,
    case when score < 0.19e0 then 'APPROVE' when score < 0.38e0 then 'REVIEW' else 'BLOCK' end as fraud_band,
    case when score < 0.28e0 then 'LIKELY TO STAY' when score < 0.28e0 + 0.25e0 then 'AT RISK'
      else 'HIGH RISK' end as churn_band,
    case when score >= 0.5e0 then 1 else 0 end as flagged,
    round(greatest(score, 1 - score), 6) as confidence
  from txn""")
def _(t):
    s = F.col("score")
    return t.txn.select("row_id", fraud_band(s, 0.19).alias("fraud_band"),
                        churn_band(s, 0.28).alias("churn_band"), at_least(s, 0.5).alias("flagged"),
                        r6(confidence(s)).alias("confidence"))


@query("night_and_day_rates", "A17 P09 F17 U03", sql="""
  select round(avg(case when is_night = 1 then is_fraud end), 6) as rate_inside,
    round(avg(case when is_night = 0 then is_fraud end), 6) as rate_outside,
    round(avg(case when is_night = 1 then is_fraud end) / avg(case when is_night = 0 then is_fraud end), 6) as ratio
  from feat""")
def _(t):
    return rounded(conditional_rates(t.features, F.col("is_night") == 1, "is_fraud"))


@query("fraud_rate_by_hour", "A07 F06 P17", sql="""
  select hour, count(*) as n, round(avg(cast(is_fraud as double)), 6) as rate,
    case when hour in (22, 23, 0, 1, 2, 3) then 'night' else 'day' end as part
  from feat group by hour""")
def _(t):
    from lopside.functions.transactions import is_night
    return rounded(rate_by(t.features, "hour", "is_fraud")).withColumn(
        "part", F.when(is_night(F.col("hour")) == 1, "night").otherwise("day"))


@query("hour_label_correlation", "A18", sql="""
  select round(corr(cast(hour as double), cast(is_fraud as double)), 6) as corr from feat""")
def _(t):
    return t.features.agg(r6(F.corr(F.col("hour").cast("double"), F.col("is_fraud").cast("double"))).alias("corr"))


@query("high_value_probe", "P10 P08 K08", sql="""
  select row_id, category, amt, hour from feat
  where category = 'cat_05' and amt between 50 and 100 order by row_id limit 200""")
def _(t):
    return (t.features.filter((F.col("category") == "cat_05") & F.col("amt").between(50, 100))
            .orderBy("row_id").limit(200).select("row_id", "category", "amt", "hour"))


@query("hour_sweep_means", "P20 J05 A29 Q03", sql="""
  with swept as (
    select f.row_id, f.score, f.amt, h.hour as at_hour,
      case when h.hour in (22, 23, 0, 1, 2, 3) then 1 else 0 end as night
    from feat f cross join (select unnest(range(24)) as hour) h)
  select cast(at_hour as int) as hour, night as is_night, count(*) as n,
    round(avg(score * 0.8e0 + 0.1e0 * night + at_hour / 1000.0e0), 6) as mean_p
  from swept group by 1, 2""")
def _(t):
    p = F.col("score") * 0.8 + 0.1 * F.col("is_night") + F.col("hour") / 1000.0
    return hour_sweep(t.features).groupBy("hour", "is_night").agg(
        F.count("*").alias("n"), r6(F.avg(p)).alias("mean_p"))


@query("card_velocity", "N01", sql="""
  with t as (select row_id, cc_num, round(amt * 100) as cents, epoch_us(trans_date_trans_time) as us from txn),
  w as (select *,
    count(*) over (partition by cc_num order by us range between 3600000000 preceding and 1 preceding) as last_1h,
    count(*) over (partition by cc_num order by us range between 86400000000 preceding and 1 preceding) as last_24h,
    count(*) over (partition by cc_num order by us range between unbounded preceding and 1 preceding) as n_past,
    avg(cents) over (partition by cc_num order by us range between unbounded preceding and 1 preceding) as past_mean,
    max(us) over (partition by cc_num order by us range between unbounded preceding and 1 preceding) as prev
   from t)
  select row_id, cc_num, last_1h, last_24h, n_past, round(past_mean, 9) as past_mean,
    case when past_mean <> 0 then round(cents / past_mean, 9) end as amount_vs_mean,
    round((us - prev) / 1e6, 9) as seconds_since_last from w""")
def _(t):
    # Whole cents, so that the sums are exact in both engines.
    cents = t.txn.withColumn("cents", F.round(F.col("amt") * 100))
    return rounded(velocity(cents, "row_id", "cc_num", "trans_date_trans_time", "cents"), 9)


@query("cyclical_hours", "N03", sql="""
  select row_id, round(sin(hour * (2 * pi() / 24)), 6) + 0 as hour_sin,
    round(cos(hour * (2 * pi() / 24)), 6) + 0 as hour_cos from feat""")
def _(t):
    s, c = hour_angle(F.col("hour"))
    return t.features.select("row_id", (r6(s) + 0).alias("hour_sin"), (r6(c) + 0).alias("hour_cos"))


@query("time_order_check", "L02 L01 A12", sql="""
  select strftime(max(a.trans_date_trans_time), '%Y-%m-%d %H:%M:%S') as train_end,
    (select strftime(min(trans_date_trans_time), '%Y-%m-%d %H:%M:%S') from txn_test) as test_start,
    max(a.trans_date_trans_time) < (select min(trans_date_trans_time) from txn_test) as in_order
  from txn_train a""")
def _(t):
    out = check_time_order(*t.txn_parts, "trans_date_trans_time")
    text = "yyyy-MM-dd HH:mm:ss"
    return out.withColumns({c: F.date_format(c, text) for c in ("train_end", "test_start")})


@query("load_summaries", "S15 A12 F15 L02", sql="""
  select 'train' as part, count(*) as n_rows, cast(cast(min(trans_date_trans_time) as date) as varchar) as first_day,
    cast(cast(max(trans_date_trans_time) as date) as varchar) as last_day,
    round(avg(cast(is_fraud as double)), 6) as positive_rate,
    round(1 - avg(cast(is_fraud as double)), 6) as baseline_accuracy from txn_train
  union all
  select 'test', count(*), cast(cast(min(trans_date_trans_time) as date) as varchar),
    cast(cast(max(trans_date_trans_time) as date) as varchar),
    round(avg(cast(is_fraud as double)), 6), round(1 - avg(cast(is_fraud as double)), 6) from txn_test""")
def _(t):
    train, test = (load_summary(p, "is_fraud", "trans_date_trans_time") for p in t.txn_parts)
    both = train.select(F.lit("train").alias("part"), "*").unionByName(test.select(F.lit("test").alias("part"), "*"))
    return rounded(both)


@query("feature_subsets", "P01 P02 P03 P21", sql="""
  select 'identity_free' as feature_set, count(*) as n, round(sum(distance_km), 2) as check_sum,
    'amt,category,hour,is_night,dayofweek,gender,distance_km' as columns from feat
  union all
  select 'transaction_only', count(*), round(sum(amt), 2), 'amt,category,hour,is_night' from feat""")
def _(t):
    a = feature_set(t.features, IDENTITY_FREE)
    b = feature_set(t.features, TRANSACTION_ONLY)
    return a.agg(F.lit("identity_free").alias("feature_set"), F.count("*").alias("n"),
                 F.round(F.sum("distance_km"), 2).alias("check_sum"),
                 F.lit(",".join(a.columns)).alias("columns")).unionByName(
        b.agg(F.lit("transaction_only").alias("feature_set"), F.count("*").alias("n"),
              F.round(F.sum("amt"), 2).alias("check_sum"), F.lit(",".join(b.columns)).alias("columns")))


@query("score_bars", "F13 F11", sql="""
  select row_id, concat(repeat('█', cast(round_even(score * 28, 0) as int)),
    repeat('·', 28 - cast(round_even(score * 28, 0) as int))) as bar,
    round(score, 4) as p from txn""")
def _(t):
    return t.txn.select("row_id", text_bar(F.col("score"), 28).alias("bar"), F.round("score", 4).alias("p"))


@query("parsed_times", "S08 F15 F06", sql="""
  select row_id, strftime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S') as at_text,
    cast(extract(hour from trans_date_trans_time) as int) as hour,
    cast(date_diff('day', dob, cast(trans_date_trans_time as date)) as int) as days_old from txn""")
def _(t):
    text = t.txn.select("row_id", F.date_format("trans_date_trans_time", "yyyy-MM-dd HH:mm:ss").alias("at_text"),
                        F.date_format("dob", "yyyy-MM-dd").alias("dob_text"))
    at = parse_timestamp(F.col("at_text"))
    return text.select("row_id", "at_text", F.hour(at).alias("hour"),
                       F.datediff(at, parse_date(F.col("dob_text"))).alias("days_old"))


@query("hour_results_json", "S12 P15", sql="""
  select row_id, 'hour,fraud_probability,decision' as fields, hour, round_even(score, 4) as fraud_probability,
    case when score >= 0.19e0 then 'block' else 'approve' end as decision from feat""")
def _(t):
    from lopside.sources.sinks import hour_result
    result = t.features.select("row_id", F.to_json(hour_result(F.col("score"), 0.19)).alias("json"))
    read = F.from_json("json", "hour int, fraud_probability double, decision string")
    return result.select("row_id", F.array_join(F.json_object_keys("json"), ",").alias("fields"), read.alias("r")).select(
        "row_id", "fields", "r.*")
