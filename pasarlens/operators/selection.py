"""Order statistics of a column without sorting it: a value's rank is narrowed down by counts per interval."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Intervals into which a range is divided in one pass; so many counts reach the driver at most for each wanted rank.
INTERVALS = 2048


def _counts(df: DataFrame, value: Column, low: float, high: float) -> list:
    """Smallest and largest value and number of values of each interval of [low, high] that has any, in order."""
    x = value.alias("x")
    # differences of halves, so that no range overflows
    share = (F.col("x") / 2 - low / 2) / (high / 2 - low / 2)
    interval = F.least(F.floor(share * INTERVALS), F.lit(INTERVALS - 1)).alias("interval")
    within = df.select(x).where(F.col("x").between(low, high))
    counted = within.groupBy(interval).agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("n"))
    return sorted(counted.collect(), key=lambda r: r["interval"])


def nth_smallest(df: DataFrame, value: Column, ranks: Sequence[int], low: float, high: float) -> list[float]:
    """The values of the given ranks (from 0) among the finite values of a column, all of which lie in [low, high].

    A pass counts the values of each interval; the one that holds the rank becomes the next range, from its smallest to its
    largest value, until these are one. Every pass narrows the range at least ``INTERVALS``-fold, so that a few passes
    do for doubles; ranks that share an interval share its passes.
    """
    found: dict[int, float] = {}
    ranges: dict[tuple[float, float, int], list[int]] = {(low, high, 0): list(ranks)}
    while ranges:
        following: dict[tuple[float, float, int], list[int]] = {}
        for (a, b, before), wanted in ranges.items():
            if a == b:
                found |= dict.fromkeys(wanted, a)
                continue
            for r in _counts(df, value, a, b):
                inside = [k for k in wanted if before <= k < before + r["n"]]
                if inside:
                    following[r["low"], r["high"], before] = inside
                before += r["n"]
        ranges = following
    return [found[k] for k in ranks]


def exact_median(df: DataFrame, value: Column) -> float | None:
    """The median of the values that are neither null nor NaN, the mean of the two middle ones of an even number; null without any.
    The driver sees counts per interval, whatever the number of rows."""
    known = df.select(value.cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    n, low, high = known.agg(F.count("*"), F.min("x"), F.max("x")).first()
    if not n:
        return None
    if math.isinf(low) or math.isinf(high):
        raise ValueError("values must be finite")
    a, b = nth_smallest(known, F.col("x"), [(n - 1) // 2, n // 2], low, high)
    return a if a == b else a / 2 + b / 2
