"""Readers on small hand-made files, and model bundles."""

import pytest
from pyspark.sql import functions as F

from lopside.operators.profile import dedup_first
from lopside.sources import readers as S
from lopside.sources import sinks


def test_long_separator(spark, tmp_path):
    path = tmp_path / "genre.txt"
    path.write_text('1 ::: Heat (1995) ::: action ::: a "quote and ::: a tail\t\n'
                    "2 ::: Up (a) (2009) ::: drama :::  NA \n", encoding="utf-8")
    rows = [tuple(r) for r in S.read_delimited(spark, str(path)).orderBy("id").collect()]
    assert rows == [(1, "Heat (1995)", "action", 'a "quote and ::: a tail'), (2, "Up (a) (2009)", "drama", "NA")]
    path.write_text("7 ::: T ::: plot\n", encoding="utf-8")
    assert tuple(S.read_delimited(spark, str(path), S.UNLABELLED_DOCUMENTS).first()) == (7, "T", "plot")


def test_broken_messages_are_repaired(spark, tmp_path):
    path = tmp_path / "sms.csv"
    path.write_bytes('v1,v2,,,\nham,"caf\xe9 ""now""",,,\nspam,"cut here", and here,,end\nham,,,,\n'
                     'spam,"cut here", and here,,end\n'.encode("latin-1"))
    raw = S.read_messages(spark, str(path))
    assert S.overflow_columns(raw) == ["_c2", "_c3", "_c4"]
    assert S.overflow_rows(raw).count() == 2
    fixed = S.repair_overflow(raw, "v2").collect()
    assert [(r["v1"], r["message"]) for r in fixed] == [
        ("ham", 'café "now"'), ("spam", "cut here, and here,end"), ("spam", "cut here, and here,end")]
    keyed = S.repair_overflow(raw.withColumn("n", F.monotonically_increasing_id()), "v2")
    assert dedup_first(keyed, ["message"], "n").count() == 2


def test_transactions_by_header_name(spark, tmp_path):
    path = tmp_path / "txn.csv"
    path.write_text(",amt,trans_date_trans_time,dob,zip,is_fraud\n"
                    "5,10.5,2020-06-21 12:14:25,1968-03-19,01234,1\n")
    row = S.read_transactions(spark, str(path)).first()
    assert row["row_id"] == 5 and row["amt"] == 10.5 and row["zip"] == "01234" and row["is_fraud"] == 1
    assert str(row["trans_date_trans_time"]) == "2020-06-21 12:14:25" and str(row["dob"]) == "1968-03-19"


def test_churn_drops_identifiers(spark, tmp_path):
    path = tmp_path / "churn.csv"
    path.write_text("RowNumber,CustomerId,Surname,CreditScore,Geography,Gender,Age,Tenure,Balance,NumOfProducts,"
                    "HasCrCard,IsActiveMember,EstimatedSalary,Exited\n1,2,A,650,France,Male,40,5,0.0,1,1,0,99.5,1\n")
    df = S.read_churn(spark, str(path))
    assert not set(S.CHURN_IDENTIFIERS) & set(df.columns) and df.first()["Exited"] == 1


@pytest.mark.parametrize("read", [S.read_delimited, S.read_churn, S.read_messages, S.read_transactions])
def test_missing_input_is_named(spark, tmp_path, read):
    with pytest.raises(S.InputMissing, match="nothing-here"):
        read(spark, str(tmp_path / "nothing-here"))


def test_blank_lines_are_not_scored(spark):
    df = spark.createDataFrame([(" hi ",), ("  \t",), ("",)], "value string")
    assert [r[0] for r in S.message_lines(df).collect()] == ["hi"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert S.nan_to_null(df).filter("x is null").count() == 1


def test_json_results(spark, tmp_path):
    df = spark.createDataFrame([("free", 0.87654)], "m string, p double")
    got = df.select(F.to_json(sinks.message_result(F.col("m"), F.col("p"), 0.5)).alias("j")).first()["j"]
    assert got == '{"message":"free","label":"spam","spam_probability":0.8765,"confidence":0.8765}'
    metrics = spark.createDataFrame([(0.5, (1, 2, 3, 4))], "f1 double, confusion_matrix struct<tn:long,fp:long,fn:long,tp:long>")
    assert sinks.metrics_json(metrics).first()["json"] == '{"f1":0.5}'
    sinks.write_json(df, str(tmp_path / "j"))
    sinks.write_table(df, str(tmp_path / "t"))
    assert spark.read.json(str(tmp_path / "j")).count() == spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_missing_bundle(spark, tmp_path):
    with pytest.raises(S.InputMissing, match="train it first"):
        sinks.load_bundle(spark, str(tmp_path / "none"))


def test_churn_columns_are_found_by_name(spark, tmp_path):
    from lopside.sources.readers import CHURN, read_churn
    names = [f.name for f in CHURN.fields]
    values = dict(zip(names, "1 15 Smith 650 France Female 40 3 0.5 1 1 0 99.5 1".split()))
    for k, order in enumerate((names, names[::-1])):
        folder = tmp_path / str(k)
        folder.mkdir()
        (folder / "a.csv").write_text(",".join(order) + "\n" + ",".join(values[n] for n in order) + "\n")
        row = read_churn(spark, str(folder), drop_identifiers=False).first()
        assert (row.CreditScore, row.Geography, row.EstimatedSalary) == (650, "France", 99.5)
    (tmp_path / "0" / "b.csv").write_text(",".join(names[::-1]) + "\n")
    with pytest.raises(Exception):
        read_churn(spark, str(tmp_path / "0")).collect()
    (tmp_path / "c.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="Geography"):
        read_churn(spark, str(tmp_path / "c.csv"))


def test_malformed_lines_are_counted(spark, tmp_path):
    from lopside.sources.readers import malformed_lines
    (tmp_path / "a.txt").write_text("1 ::: t ::: g ::: d\nx ::: t ::: g ::: d\n2 ::: t\n3 ::: t ::: g ::: d ::: more\n")
    assert tuple(malformed_lines(spark, str(tmp_path / "a.txt")).first()) == (4, 2)
