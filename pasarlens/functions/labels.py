"""Labels derived from measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels and limits that reports are keyed by.
LOW_STOCK_BELOW = 10
PRICE_LOW_BELOW = 50000
PRICE_MEDIUM_BELOW = 200000
SEGMENTS = ["High Price, Low Sales", "Budget Products", "Best Sellers", "Premium Products", "Standard Products"]


def stock_status(stock: Column) -> Column:
    """Unknown stock counts as in stock."""
    return (
        F.when(stock == 0, "OUT_OF_STOCK").when(stock < LOW_STOCK_BELOW, "LOW_STOCK").otherwise("IN_STOCK")
    )


def price_category(average_price: Column) -> Column:
    return (
        F.when(average_price < PRICE_LOW_BELOW, "LOW")
        .when(average_price < PRICE_MEDIUM_BELOW, "MEDIUM")
        .otherwise("HIGH")
    )


def discount_range(discount_percent: Column) -> Column:
    """Band of a discount; an unknown discount lands in the last band."""
    return (
        F.when(discount_percent == 0, "No Discount")
        .when(discount_percent < 20, "1-20%")
        .when(discount_percent < 40, "20-40%")
        .otherwise("40%+")
    )


def segment_name(segment: Column) -> Column:
    """Name of a one-based segment number; numbers past the list take the last name."""
    position = F.least(segment.cast("int"), F.lit(len(SEGMENTS)))
    return F.element_at(F.array(*[F.lit(name) for name in SEGMENTS]), position)
