"""Numeric and banding expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def evenly_spaced(start: float, stop: float, n: int) -> list[float]:
    """``n`` doubles from ``start`` to ``stop``; both engines of a test share them."""
    step = (stop - start) / (n - 1)
    return [start + i * step for i in range(n - 1)] + [stop]


THRESHOLDS = evenly_spaced(0.05, 0.95, 91)
FINE_THRESHOLDS = evenly_spaced(0.05, 0.95, 181)


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, 0 where the bottom is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def alarms_per_hit(precision: Column) -> Column:
    """Alarms raised for each case caught, 1 / precision; null where none is caught."""
    return F.try_divide(F.lit(1.0), precision)


def count_when(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


def sum_when(condition: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0.0))


def right_closed_band(value: Column, edges: Sequence[float],
                      labels: Sequence[str] | None = None) -> Column:
    """Label of the interval ``(a, b]`` holding ``value``; null outside all of them."""
    return _band(value, edges, labels or [f"({a:g}, {b:g}]" for a, b in zip(edges, edges[1:])])


def right_closed_band_order(value: Column, edges: Sequence[float]) -> Column:
    """Position of that interval, for sorting bands."""
    return _band(value, edges, list(range(len(edges) - 1)))


def _band(value: Column, edges, names) -> Column:
    if len(names) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    out = F.lit(None)
    for a, b, name in reversed(list(zip(edges, edges[1:], names))):
        out = F.when((value > a) & (value <= b), F.lit(name)).otherwise(out)
    return out


def at_least(score: Column, threshold: float) -> Column:
    """1 from the threshold on, the threshold itself included."""
    return (score >= F.lit(float(threshold))).cast("int")


def fraud_band(p: Column, threshold: float) -> Column:
    return (F.when(p < threshold, F.lit("APPROVE"))
            .when(p < 2 * threshold, F.lit("REVIEW")).otherwise(F.lit("BLOCK")))


def churn_band(p: Column, threshold: float) -> Column:
    return (F.when(p < threshold, F.lit("LIKELY TO STAY"))
            .when(p < threshold + 0.25, F.lit("AT RISK")).otherwise(F.lit("HIGH RISK")))


def confidence(p: Column) -> Column:
    return F.greatest(p, 1 - p)


def f1_band(f1: Column) -> Column:
    return (F.when(f1 < 0.30, F.lit("broken")).when(f1 < 0.50, F.lit("weak"))
            .otherwise(F.lit("usable")))


def blank_small(value: Column, floor: float = 0.05) -> Column:
    """Two decimals, null below ``floor``."""
    return F.when(value >= floor, F.round(value, 2))


def text_bar(p: Column, width: int) -> Column:
    filled = F.rint(p * width).cast("int")
    return F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("·"), F.lit(width) - filled))


def percent_text(p: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", p * 100)


def money_text(amount: Column, digits: int = 0) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, digits))
