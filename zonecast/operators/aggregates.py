"""Exact aggregate helpers: sums of raw values in ten-thousandths, rounded once at the end, halves away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonecast.functions import columns as C


def sum_money(c: str | Column) -> Column:
    """Sum of a money column, rounded to cents (null if every input is null)."""
    return C.from_cents(C.half_up_ratio(F.sum(C.to_units(c)), F.lit(100)))


def mean_2(c: str | Column) -> Column:
    """round(avg(c), 2) of values with up to 4 decimals."""
    return C.from_cents(C.half_up_ratio(F.sum(C.to_units(c)), F.count(c) * 100))


def mean_3(c: str | Column) -> Column:
    """round(avg(c), 3) of values with up to 4 decimals."""
    return C.half_up_ratio(F.sum(C.to_units(c)), F.count(c) * 10) / F.lit(1000.0)


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def rate_pct_2(part: Column, whole: Column) -> Column:
    """round(100 * part / nullif(whole, 0), 2) half-up, for non-negative integer inputs."""
    return C.half_up_ratio(part * 10000, whole) / F.lit(100.0)
