"""Values worked out by hand, one group per trap."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lopside.functions import numbers as N
from lopside.functions import text as X
from lopside.functions import transactions as T


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize("title, want", [
    ("Heat (1995)", "Heat"), ("Up (a film) in parts (2009) ", "Up"), ("No brackets", "No brackets"),
    ("(untitled)", ""), ("Open ( never closed", "Open ( never closed")])
def test_title_loses_everything_from_the_first_bracket(spark, title, want):
    assert one(spark, X.strip_parenthetical(F.col("t")), t=title) == want


def test_missing_part_gives_missing_text(spark):
    df = spark.createDataFrame([("A (1)", "b"), (None, "b")], "t string, d string")
    rows = [r[0] for r in df.select(X.build_text(F.col("t"), F.col("d"))).collect()]
    assert rows == ["A . b", None]


def test_space_is_stripped_like_python_does(spark):
    assert one(spark, X.strip_space(F.col("t")), t=" \t a b \n") == "a b"


def test_char_ngrams_of_the_worked_example(spark):
    grams = one(spark, X.char_wb_ngrams(F.col("t"), 3, 5), t="Hi FR33  a")
    assert grams == [" hi", "hi ", " hi ", " fr", "fr3", "r33", "33 ", " fr3", "fr33", "r33 ",
                     " fr33", "fr33 ", " a "]


def char_wb_by_hand(text, low, high):
    out = []
    for word in text.lower().split():
        word = f" {word} "
        for n in range(low, high + 1):
            if len(word) <= n:
                out.append(word)
                break
            out += [word[i:i + n] for i in range(len(word) - n + 1)]
    return out


@pytest.mark.parametrize("low, high", [(3, 5), (1, 2), (4, 6), (2, 2)])
def test_char_ngrams_against_plain_loops(spark, low, high):
    text = "A bc  def ghij klmno pqrstu\tÉtat vwxyz12345"
    assert one(spark, X.char_wb_ngrams(F.col("t"), low, high), t=text) == char_wb_by_hand(text, low, high)


def test_tokens_have_two_letters(spark):
    df = spark.createDataFrame([("Café a I'm W1NNER x_y",)], "t string")
    assert X.with_terms(df, "t").first()["terms"] == ["café", "w1nner", "x_y"]


def test_ngrams_follow_stop_word_removal(spark):
    df = spark.createDataFrame([("the world at war",), ("war",), ("",)], "t string")
    rows = X.with_terms(df, "t", ngram_range=(1, 2), stop_words=["the", "at"]).collect()
    assert [r["terms"] for r in rows] == [["world", "war", "world war"], ["war"], []]


def test_accents(spark):
    text = "Étion çouelle ß œ ﬁn é Ǆ"
    assert one(spark, X.strip_accents(F.col("t")), t=text) == "Etion couelle ß œ fin e DZ"


def test_overflow_parts(spark):
    df = spark.createDataFrame([("a", "b", None, "d")], "a string, b string, c string, d string")
    assert df.select(X.join_parts(*[F.col(c) for c in "abcd"])).first()[0] == "a,b,d"


def test_word_count_and_shorten(spark):
    assert one(spark, X.word_count(F.col("t")), t="  two\n\twords ") == 2
    assert one(spark, X.shorten(F.col("t"), 3), t="abcd") == "abc..."
    assert one(spark, X.shorten(F.col("t"), 3), t="abc") == "abc"


def test_bands_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.01, 10.0, 10.01, 30000.0, 30000.01)], "x double")
    rows = [r[0] for r in df.select(N.right_closed_band(F.col("x"), [0, 10, 30000], ["low", "high"])).collect()]
    assert rows == [None, "low", "low", "high", "high", None]


def test_cut_includes_the_threshold(spark):
    assert one(spark, N.at_least(F.col("p"), 0.5), p=0.5) == 1
    assert one(spark, N.at_least(F.col("p"), 0.5), p=0.4999) == 0


def test_decision_bands(spark):
    df = spark.createDataFrame([(0.18,), (0.19,), (0.38,), (0.53,)], "p double")
    p = F.col("p")
    rows = df.select(N.fraud_band(p, 0.19), N.churn_band(p, 0.28)).collect()
    assert [tuple(r) for r in rows] == [("APPROVE", "LIKELY TO STAY"), ("REVIEW", "LIKELY TO STAY"),
                                        ("BLOCK", "AT RISK"), ("BLOCK", "HIGH RISK")]


def test_bar_rounds_half_to_even(spark):
    assert one(spark, N.text_bar(F.col("p"), 4), p=0.125) == "····"
    assert one(spark, N.text_bar(F.col("p"), 4), p=0.375) == "██··"


def test_number_texts(spark):
    assert one(spark, N.percent_text(F.col("p")), p=0.1234) == "12.3%"
    assert one(spark, N.money_text(F.col("p")), p=1133324.6) == "$1,133,325"


def test_grid_has_both_ends():
    assert len(N.THRESHOLDS) == 91 and len(N.FINE_THRESHOLDS) == 181
    assert N.THRESHOLDS[0] == 0.05 and N.THRESHOLDS[-1] == 0.95


def transactions(spark):
    rows = [
        (1, dt.datetime(2020, 6, 21, 21, 59, 59), dt.date(1980, 2, 29), 10.0, 40.0, -75.0, 40.0, -75.0),
        (2, dt.datetime(2020, 6, 22, 22, 0, 0), dt.date(1980, 2, 29), 10.0, 0.0, 0.0, 0.0, 1.0),
        (3, dt.datetime(2020, 6, 23, 3, 0, 0), dt.date(2000, 6, 23), 10.0, 0.0, 0.0, 90.0, 0.0),
        (4, dt.datetime(2020, 6, 24, 4, 0, 0), dt.date(2000, 6, 24), 10.0, 0.0, 0.0, 0.0, 180.0)]
    return spark.createDataFrame(
        rows, "row_id long, trans_date_trans_time timestamp_ntz, dob date, amt double, lat double, long double,"
              " merch_lat double, merch_long double").selectExpr("*", "'c' category", "'F' gender", "5L city_pop")


def test_transaction_features(spark):
    rows = T.engineer_transactions(transactions(spark), keep=("row_id",)).orderBy("row_id").collect()
    assert rows[0].__fields__ == ["row_id", *T.FEATURES]
    assert [r["hour"] for r in rows] == [21, 22, 3, 4]
    assert [r["is_night"] for r in rows] == [0, 1, 1, 0]
    assert [r["dayofweek"] for r in rows] == [6, 0, 1, 2]  # 21 June 2020 was a Sunday
    assert rows[0]["age"] == (dt.date(2020, 6, 21) - dt.date(1980, 2, 29)).days / 365.25
    radius = 6371.0
    want = [0.0, radius * math.radians(1), radius * math.pi / 2, radius * math.pi]
    assert [r["distance_km"] for r in rows] == pytest.approx(want, abs=1e-6)


def test_hour_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = transactions(spark)
        hours = [r["hour"] for r in T.engineer_transactions(df, keep=("row_id",)).orderBy("row_id").collect()]
        micros = [r[0] for r in df.orderBy("row_id").select(T.epoch_micros(F.col("trans_date_trans_time"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert hours == [21, 22, 3, 4]
    epoch = dt.datetime(1970, 1, 1)
    assert micros[0] == (dt.datetime(2020, 6, 21, 21, 59, 59) - epoch) // dt.timedelta(microseconds=1)


def test_sweep_keeps_rows_and_recomputes_night(spark):
    swept = T.hour_sweep(T.engineer_transactions(transactions(spark)))
    assert swept.count() == 4 * 24
    assert {r["hour"] for r in swept.filter("is_night = 1").collect()} == set(T.NIGHT_HOURS)
