"""Column expressions shared by the operators.

All built-in Spark functions: they stay inside whole-stage codegen and never
leave the JVM. Money is handled as integer cents and surge as integer
hundredths so results do not depend on binary rounding of doubles; the last step
divides by 100.0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonecast.functions import constants as K


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a: Column, b: Column | int) -> Column:
    """Integer division truncating toward zero (Spark ``div``)."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def to_cents(x: str | Column) -> Column:
    """A money value with at most 2 decimals, as exact integer cents (null stays null)."""
    return F.round(col(x) * 100).cast("long")


def to_hundredths(x: str | Column) -> Column:
    return F.round(col(x) * 100).cast("long")


def to_units(x: str | Column) -> Column:
    """A value with at most 4 decimals as exact integer ten-thousandths."""
    return F.round(col(x) * 10000).cast("long")


def from_cents(c: Column) -> Column:
    return c / F.lit(100.0)


def half_up_ratio(num: Column, den: Column) -> Column:
    """round(num / den), halves away from zero, den > 0, in integer arithmetic; null if den is 0."""
    up = idiv(F.abs(num) * 2 + den, den * 2)
    return F.when(den > 0, F.when(num < 0, -up).otherwise(up))


def money_times(amount: str | Column, factor: str | Column) -> Column:
    """round(amount x factor, 2), halves away from zero, on decimal values: the amount keeps six places and the
    factor eight, and only the product is rounded.

    NaN and null give null. An amount of 10**14 or a factor of 10**8 and more is no fare: it fails the job (ANSI
    cast) instead of leaving the sums unseen.
    """
    def exact(x: Column, kind: str) -> Column:
        return F.when(~F.isnan(x.cast("double")), x).cast(kind)

    prod = exact(col(amount), "decimal(20,6)") * exact(col(factor), "decimal(16,8)")
    return F.round(prod, 2).cast("double")


def round_half_up_2(x: str | Column) -> Column:
    """round(x, 2) half-up for a real-valued double: floor(x * 100 + 0.5) / 100."""
    return F.floor(col(x) * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)


def parse_event_ts(x: str | Column) -> Column:
    """ISO-8601 text (with offset) to TIMESTAMP; unparseable text gives null (ANSI-safe)."""
    return F.try_to_timestamp(col(x))


def iso_text(ts: str | Column) -> Column:
    """Event time rendered the way the event producers write it (microseconds, +00:00)."""
    return F.concat(F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def zone_factor_tenths(zone: str | Column) -> Column:
    z = col(zone)
    expr = None
    for name, _, _, factor in K.ZONES:
        expr = (F.when(z == name, K.tenths(factor)) if expr is None
                else expr.when(z == name, K.tenths(factor)))
    return expr


def demand_tenths(hour: str | Column) -> Column:
    h = col(hour)
    return (
        F.when(h.between(*K.PEAK_HOURS_MORNING) | h.between(*K.PEAK_HOURS_EVENING), K.tenths(K.PEAK_DEMAND))
        .when(h.between(*K.NIGHT_HOURS), K.tenths(K.NIGHT_DEMAND))
        .when(h.isNotNull(), K.tenths(K.NORMAL_DEMAND))
    )


def weather_tenths(weather: str | Column) -> Column:
    w = col(weather)
    expr = None
    for name in K.WEATHER_STATES:
        t = K.tenths(K.WEATHER_DEMAND[name])
        expr = F.when(w == name, t) if expr is None else expr.when(w == name, t)
    return expr


def surge_rule_hundredths(zone: str | Column, hour: str | Column, weather: str | Column) -> Column:
    """Surge rule: demand(hour) x weather x zone / 2, clamped to [1.0, 3.5], half-up to 2 places.

    Product of three tenths is in thousandths; hundredths = product / 20, rounded
    half-up. Unknown zone or weather gives null.
    """
    prod = demand_tenths(hour) * weather_tenths(weather) * zone_factor_tenths(zone)
    lo, hi = int(K.SURGE_MIN * 100), int(K.SURGE_MAX * 100)
    # greatest / least skip nulls, so an unknown input must stay null explicitly
    return F.when(prod.isNotNull(), F.least(F.lit(hi), F.greatest(F.lit(lo), idiv(prod + 10, 20)))).cast("long")


def surge_rule(zone: str | Column, hour: str | Column, weather: str | Column) -> Column:
    return from_cents(surge_rule_hundredths(zone, hour, weather))


def day_period(hour: str | Column) -> Column:
    """Notebook day-period CASE; first matching arm wins."""
    h = col(hour)
    return (
        F.when(h.between(7, 10), "morning_peak")
        .when(h.between(17, 21), "evening_peak")
        .when(h.between(0, 5), "night")
        .otherwise("off_peak")
    )


def surge_out_of_band(surge: str | Column) -> Column:
    """True when outside [1.0, 3.5]; null surge is never out of band."""
    s = col(surge)
    return F.coalesce((s < K.SURGE_MIN) | (s > K.SURGE_MAX), F.lit(False))


def hist_zone(location_id: str | Column, nan_text: bool = False) -> Column:
    """Right-closed bins (0,50] A ... (200, inf) E; outside or null gives null ("nan" when asked)."""
    x = col(location_id)
    edges, labels = K.HIST_ZONE_EDGES, K.HIST_ZONE_LABELS
    expr = None
    for i, label in enumerate(labels):
        cond = x > edges[i]
        if i + 1 < len(edges):
            cond = cond & (x <= edges[i + 1])
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit("nan")) if nan_text else expr


def hist_payment(code: str | Column) -> Column:
    c = col(code)
    expr = None
    for k, name in K.HIST_PAYMENT_CODES.items():
        expr = F.when(c == k, name) if expr is None else expr.when(c == k, name)
    return expr.otherwise("other")
