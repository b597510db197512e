"""Readers with declared schemas; a missing input is an error that names the path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lopside.functions.text import join_parts, strip_space

DOCUMENTS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("genre", T.StringType()), T.StructField("description", T.StringType())])
UNLABELLED_DOCUMENTS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType())])

_TRANSACTION_TYPES = {
    "trans_date_trans_time": T.StringType(), "cc_num": T.LongType(), "merchant": T.StringType(),
    "category": T.StringType(), "amt": T.DoubleType(), "first": T.StringType(),
    "last": T.StringType(), "gender": T.StringType(), "street": T.StringType(),
    "city": T.StringType(), "state": T.StringType(), "zip": T.StringType(), "lat": T.DoubleType(),
    "long": T.DoubleType(), "city_pop": T.LongType(), "job": T.StringType(), "dob": T.StringType(),
    "trans_num": T.StringType(), "unix_time": T.LongType(), "merch_lat": T.DoubleType(),
    "merch_long": T.DoubleType(), "is_fraud": T.IntegerType()}

CHURN = T.StructType([
    T.StructField("RowNumber", T.LongType()), T.StructField("CustomerId", T.LongType()),
    T.StructField("Surname", T.StringType()), T.StructField("CreditScore", T.IntegerType()),
    T.StructField("Geography", T.StringType()), T.StructField("Gender", T.StringType()),
    T.StructField("Age", T.IntegerType()), T.StructField("Tenure", T.IntegerType()),
    T.StructField("Balance", T.DoubleType()), T.StructField("NumOfProducts", T.IntegerType()),
    T.StructField("HasCrCard", T.IntegerType()), T.StructField("IsActiveMember", T.IntegerType()),
    T.StructField("EstimatedSalary", T.DoubleType()), T.StructField("Exited", T.IntegerType())])
CHURN_IDENTIFIERS = ["RowNumber", "CustomerId", "Surname"]


class InputMissing(FileNotFoundError):
    """A required input is not there."""


def require(build, path: str) -> DataFrame:
    try:
        return build()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "does not exist" in str(error):
            raise InputMissing(f"input not found: {path}") from error
        raise


def read_delimited(spark: SparkSession, path: str, schema: T.StructType = DOCUMENTS,
                   sep: str = " ::: ") -> DataFrame:
    """Text lines cut at a long separator, without quoting.

    The last column keeps any further separators. Every column but the first is
    stripped of white space.
    """
    lines = require(lambda: spark.read.text(path), path)
    parts = F.split("value", sep.replace("|", r"\|"), len(schema))
    columns = []
    for i, field in enumerate(schema.fields):
        part = F.try_element_at(F.col("_parts"), F.lit(i + 1))
        value = part if i == 0 else strip_space(part)
        columns.append(value.try_cast(field.dataType).alias(field.name))
    return lines.select(parts.alias("_parts")).select(*columns)


def malformed_lines(spark: SparkSession, path: str, schema: T.StructType = DOCUMENTS,
                    sep: str = " ::: ") -> DataFrame:
    """How many lines there are, and how many lack a column or hold a value of another type.

    ``read_delimited`` gives such lines nulls; a load should check this count first.
    """
    lines = require(lambda: spark.read.text(path), path)
    parts = F.split("value", sep.replace("|", r"\|"), len(schema))
    wrong = F.size("_parts") < len(schema)
    for i, field in enumerate(schema.fields):
        part = F.try_element_at(F.col("_parts"), F.lit(i + 1))
        wrong = wrong | (part.isNotNull() & part.try_cast(field.dataType).isNull())
    return lines.select(parts.alias("_parts")).agg(
        F.count("*").alias("n_lines"), F.coalesce(F.sum(wrong.cast("bigint")), F.lit(0)).alias("n_malformed"))


def parse_timestamp(c: Column) -> Column:
    return F.to_timestamp_ntz(c, F.lit("yyyy-MM-dd HH:mm:ss"))


def parse_date(c: Column) -> Column:
    return F.to_date(c, "yyyy-MM-dd")


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV whose unnamed first column is a row id.

    The header line gives the column order; the types are declared here.
    """
    header = require(lambda: spark.read.option("header", True).csv(path), path).columns
    schema = T.StructType([
        T.StructField("row_id", T.LongType()) if i == 0
        else T.StructField(name, _TRANSACTION_TYPES.get(name, T.StringType()))
        for i, name in enumerate(header)])
    raw = spark.read.schema(schema).csv(path, header=True, enforceSchema=True)
    return raw.withColumns({
        "trans_date_trans_time": parse_timestamp(F.col("trans_date_trans_time")),
        "dob": parse_date(F.col("dob"))})


def read_churn(spark: SparkSession, path: str, drop_identifiers: bool = True) -> DataFrame:
    """Columns are found by their names; a file with another header than the first is an error."""
    header = require(lambda: spark.read.option("header", True).csv(path), path).columns
    missing = [f.name for f in CHURN.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    types = {f.name: f.dataType for f in CHURN.fields}
    schema = T.StructType([T.StructField(name, types.get(name, T.StringType())) for name in header])
    raw = spark.read.schema(schema).csv(path, header=True, enforceSchema=False).select(*types)
    return raw.drop(*CHURN_IDENTIFIERS) if drop_identifiers else raw


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Latin-1 CSV: label, text and the unnamed overflow columns ``_c2``.. ."""
    def build() -> DataFrame:
        return spark.read.csv(path, header=True, encoding="ISO-8859-1", quote='"', escape='"',
                              multiLine=True)
    return require(build, path)


def overflow_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("_c") and c[2:].isdigit()]


def overflow_rows(df: DataFrame, overflow: Sequence[str] | None = None) -> DataFrame:
    names = overflow_columns(df) if overflow is None else list(overflow)
    return df.filter(F.coalesce(*[F.col(c) for c in names]).isNotNull())


def repair_overflow(df: DataFrame, text: str, overflow: Sequence[str] | None = None,
                    out: str = "message") -> DataFrame:
    """Re-join texts cut at a comma. Rows without text are dropped, not named 'nan'."""
    names = overflow_columns(df) if overflow is None else list(overflow)
    return (df.filter(F.col(text).isNotNull())
            .withColumn(out, join_parts(F.col(text), *[F.col(c) for c in names])).drop(*names))


def message_lines(df: DataFrame, text: str = "value") -> DataFrame:
    """Stripped, non-blank lines to score."""
    return df.withColumn(text, strip_space(F.col(text))).filter(F.col(text) != "")


def nan_to_null(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles}) if doubles else df
