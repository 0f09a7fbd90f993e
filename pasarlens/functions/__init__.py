"""Column expressions shared by the operators."""

from pasarlens.functions.calendar import in_window, is_weekend, month_text, week_start, weekday_name, window_start
from pasarlens.functions.labels import discount_range, price_category, segment_name, stock_status
from pasarlens.functions.money import as_exact, discounted, exact_avg, exact_stddev, exact_sum, is_finite
from pasarlens.functions.text import strip

__all__ = [
    "discount_range",
    "discounted",
    "as_exact",
    "exact_avg",
    "exact_stddev",
    "exact_sum",
    "in_window",
    "is_finite",
    "is_weekend",
    "month_text",
    "price_category",
    "segment_name",
    "stock_status",
    "strip",
    "week_start",
    "weekday_name",
    "window_start",
]
