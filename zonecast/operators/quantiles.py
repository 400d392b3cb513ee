"""Exact quantiles by selection in several passes, without a counter per value.

One pass counts the rows of BINS equal ranges between the bounds, with the smallest and largest value of each; the ranges that hold a wanted rank
become the bounds of the next pass. A range is done when all its values are equal or it has at most FEW rows, which are then fetched in
order. Every pass is one grouped count with partial aggregation, and what comes to the driver is bounded by the number of ranges (BINS for
each rank) and FEW rows for each, whatever the number of rows or of distinct values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024
FEW = 1000
MAX_PASSES = 400


def _bin(x: Column, low: float, high: float) -> Column:
    """Range of a value; rises with the value. Halves, as the difference of two doubles may not be one."""
    share = (x * 0.5 - low * 0.5) / F.lit(high * 0.5 - low * 0.5)
    return F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor(share * BINS).cast("int")))


def _select(values: DataFrame, n: int, low: float, high: float, ranks: list[int]) -> dict[int, float]:
    """Value at each rank (from 0) of ``values`` (column x, no nulls)."""
    done: dict[int, float] = {}
    # (low, high, rows below, rows) -> ranks
    spans = {(low, high, 0, n): sorted(set(ranks))}
    for _ in range(MAX_PASSES):
        wide = {}
        for (lo, hi, below, rows), wanted in spans.items():
            if lo == hi:
                done |= {r: lo for r in wanted}
            elif rows <= FEW:
                found = [r["x"] for r in values.where(F.col("x").between(lo, hi)).orderBy("x").collect()]
                done |= {r: found[r - below] for r in wanted}
            else:
                wide[lo, hi, below, rows] = wanted
        if not wide:
            return done
        place, cell = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (lo, hi, _, _) in enumerate(wide):
            inside = F.col("x").between(lo, hi)
            place, cell = F.when(inside, F.lit(i)).otherwise(place), F.when(inside, _bin(F.col("x"), lo, hi)).otherwise(cell)
        counted = (values.select("x", place.alias("span"), cell.alias("bin")).where("span is not null")
                   .groupBy("span", "bin").agg(F.count("*").alias("rows"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
        spans = {}
        for i, ((_, _, below, _), wanted) in enumerate(wide.items()):
            before = below
            for r in sorted((r for r in counted if r["span"] == i), key=lambda r: r["bin"]):
                here = [k for k in wanted if before <= k < before + r["rows"]]
                if here:
                    spans[r["lo"], r["hi"], before, r["rows"]] = here
                before += r["rows"]
    raise RuntimeError(f"quantiles did not settle in {MAX_PASSES} passes")


def exact_quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """Quantiles of a numeric column with linear interpolation between neighbours; nulls and NaN do not count, and without values all are None."""
    values = df.select(F.col(column).cast("double").alias("x")).where("x is not null and not isnan(x)")
    s = values.agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    n = s["n"]
    if n == 0:
        return [None] * len(shares)
    at = [share * (n - 1) for share in shares]
    ranks = [r for p in at for r in (math.floor(p), math.ceil(p))]
    found = _select(values, n, s["lo"], s["hi"], ranks)
    out = []
    for p in at:
        a, b = found[math.floor(p)], found[math.ceil(p)]
        out.append(a if a == b else a + (b - a) * (p - math.floor(p)))
    return out
