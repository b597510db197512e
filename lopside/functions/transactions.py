"""Features of a card transaction, all plain column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that the results depend on.
EARTH_RADIUS_KM = 6371.0
DAYS_PER_YEAR = 365.25
NIGHT_HOURS = [22, 23, 0, 1, 2, 3]

FEATURES = ["amt", "category", "hour", "is_night", "dayofweek", "age", "gender",
            "city_pop", "distance_km"]
CATEGORICAL = ["category", "gender"]
IDENTITY_FREE = ["amt", "category", "hour", "is_night", "dayofweek", "gender", "distance_km"]
TRANSACTION_ONLY = ["amt", "category", "hour", "is_night"]


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = (F.sin(half_lat) * F.sin(half_lat)
             + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lon) * F.sin(half_lon))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def is_night(hour: Column) -> Column:
    return hour.isin(NIGHT_HOURS).cast("int")


def age_years(at: Column, born: Column) -> Column:
    return F.datediff(at, born) / F.lit(DAYS_PER_YEAR)


def iso_weekday(at: Column) -> Column:
    """Monday is 0."""
    return F.weekday(at)


def hour_angle(hour: Column) -> tuple[Column, Column]:
    """Hour as a point on the circle (sine, cosine)."""
    turn = hour * F.lit(2 * math.pi / 24)
    return F.sin(turn), F.cos(turn)


def engineer_transactions(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The nine model features, in a fixed order, after the columns to ``keep``."""
    at = F.col("trans_date_trans_time")
    hour = F.hour(at)
    return df.select(
        *[k for k in keep if k not in FEATURES],
        "amt", "category",
        hour.alias("hour"),
        is_night(hour).alias("is_night"),
        iso_weekday(at).alias("dayofweek"),
        age_years(at, F.col("dob")).alias("age"),
        "gender", "city_pop",
        haversine_km(F.col("lat"), F.col("long"),
                     F.col("merch_lat"), F.col("merch_long")).alias("distance_km"),
    )


def hour_sweep(df: DataFrame) -> DataFrame:
    """Each row once for every hour of the day, with ``is_night`` to match.

    An exploded literal, so the copies are made inside the scan stage.
    """
    hours = F.explode(F.sequence(F.lit(0), F.lit(23)))
    return df.withColumn("hour", hours).withColumn("is_night", is_night(F.col("hour")))


def epoch_micros(at: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone."""
    days = F.datediff(at, F.lit("1970-01-01").cast("date")).cast("bigint")
    second = F.extract(F.lit("SECOND"), at)
    return (days * F.lit(86_400_000_000)
            + F.hour(at).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(at).cast("bigint") * F.lit(60_000_000)
            + (second * F.lit(1_000_000)).cast("bigint"))
