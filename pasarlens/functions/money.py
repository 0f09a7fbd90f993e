"""Order-independent arithmetic for money and measures.

A sum of doubles depends on the order in which partial sums meet, so a retried task could change the last
digits. Sums therefore run on decimals (still a hash aggregate with map-side partials) and only the final
value becomes a double again. Six decimals are kept, and 22 digits before the point: prices, ratings and percentages
are not rounded on the way in, and no plausible value overflows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_exact(value: Column | str, scale: int = 6) -> Column:
    """The value as a decimal; null if it is not a number, infinite or too large."""
    return _as_column(value).try_cast(T.DecimalType(22 + scale, scale))


def exact_sum(value: Column | str, scale: int = 6) -> Column:
    return F.sum(as_exact(value, scale)).cast("double")


def exact_avg(value: Column | str, scale: int = 6) -> Column:
    """Mean of the values that can be summed exactly; null when there are none."""
    return F.try_divide(exact_sum(value, scale), F.count(as_exact(value, scale)))


def is_finite(value: Column | str) -> Column:
    """Whether a double is neither NaN nor infinite; null for null."""
    return F.abs(_as_column(value)) < F.lit(float("inf"))


def exact_stddev(count: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from a count, an exact sum and an exact sum of squares.

    Null for fewer than two values. ``total`` and ``squares`` are whole numbers held as decimals.
    """
    spread = (count.cast("decimal(18,0)") * squares - total * total).cast("double")
    return F.sqrt(F.try_divide(spread, (count * (count - 1)).cast("double")))


def discounted(price: Column, discount_percent: Column) -> Column:
    """Price after discount, rounded half up to cents; a missing discount counts as none, and so does one that is not finite. Price and
    discount enter with six decimals; a discount above 100 gives a negative price, as it says. Prices from 10^12 on, whose cents a
    double hardly holds, are reckoned as doubles."""
    kept = 100 - F.coalesce(F.when(is_finite(discount_percent), discount_percent), F.lit(0.0))
    exact = price.try_cast("decimal(18,6)") * kept.try_cast("decimal(14,6)") * F.lit(0.01).cast("decimal(2,2)")
    return F.coalesce(F.round(exact, 2).cast("double"), F.round(price * kept / 100, 2))
