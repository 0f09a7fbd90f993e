from datetime import date, timedelta

import pytest

from pasarlens.plans import features as f
from pasarlens.plans import snapshot_reports as r

START = date(2024, 1, 1)


def days(spark, counts, gap=1):
    """Product ``i`` with ``counts[i]`` selling days, ``gap`` days apart, units 1, 2, 3, ..."""
    rows = [
        (f"p{i}", f"name {i}", "c", START + timedelta(days=gap * n), n + 1) for i, c in enumerate(counts) for n in range(c)
    ]
    return spark.createDataFrame(
        rows, "product_id string, product_name string, category string, sale_date date, daily_sales bigint"
    )


@pytest.mark.parametrize("gap", [1, 3])
def test_lags_and_averages_count_rows(spark, gap):
    table = f.moving_averages(f.sales_lags(days(spark, [1, 2, 8, 31], gap)))
    last = {}
    for row in table.orderBy("product_id", "sale_date").collect():
        last[row.product_id] = row
    assert (last["p0"].sales_lag_1, last["p0"].sales_ma_7) == (None, 1.0)
    assert (last["p1"].sales_lag_1, last["p1"].sales_ma_30) == (1, 1.5)
    assert (last["p2"].sales_lag_7, last["p2"].sales_ma_7, last["p2"].sales_lag_30) == (1, 5.0, None)
    assert (last["p3"].sales_lag_30, last["p3"].sales_ma_30) == (1, 16.5)


def cleaned(spark, rows):
    return spark.createDataFrame(
        rows,
        "product_id string, product_name string, category string, sale_date date, price double, "
        "discount_percent double, sales_count bigint, rating double, review_count bigint",
    )


def test_features_drop_first_days(spark):
    rows = [("p", "n", "c", START + timedelta(days=i), 60000.0, None, 2, 4.0, 5 + i) for i in (0, 1, 1, 5)]
    out = f.ml_features(cleaned(spark, rows)).orderBy("sale_date").collect()
    assert [(x.daily_sales, x.sales_lag_1, x.review_count) for x in out] == [(4, 2, 6), (2, 4, 10)]
    assert out[1].is_weekend == 1 and out[1].day_of_week == 7 and out[1].price_category == "MEDIUM"
    assert out[0].avg_discount is None


def test_seq_split_keeps_days_together(spark):
    rows = days(spark, [10, 10])
    split = f.seq_split(rows)
    assert split.count() == 20
    evaluation = {x.sale_date for x in split.where("is_eval").collect()}
    assert evaluation == {START + timedelta(days=8), START + timedelta(days=9)}


def test_daily_totals_breaks_ties_and_orders_unknown_last(spark):
    df = spark.createDataFrame(
        [
            (START, "b", 10.0, 5, 50.0),
            (START, "a", None, 5, None),
            (START, "0", 1.0, None, None),
            (START + timedelta(1), "z", 2.0, 1, 2.0),
        ],
        "ingestion_date date, category string, price double, sales_count bigint, revenue double",
    )
    row = r.daily_summary_snapshot(df, START).first()
    assert tuple(row) == (START, 50.0, 10, 5.5, "a")
    empty = r.daily_summary_snapshot(df, date(2030, 1, 1))
    assert [tuple(x) for x in empty.collect()] == [(date(2030, 1, 1), None, None, None, None)]


def test_weekly_trend_needs_enough_weeks(spark):
    as_of = date(2024, 3, 3)  # a Sunday
    weeks = [as_of - timedelta(days=7 * i) for i in range(4)]
    rows = [("p", "steady", "c", d, 1.0, None, n, None, None) for d, n in zip(weeks, (1, 2, 3, 4))]
    rows += [("q", "rare", "c", d, 1.0, None, 9, None, None) for d in weeks[:3]]
    out = r.weekly_trend(cleaned(spark, rows), as_of).collect()
    assert [(x.product_name, x.avg_weekly_sales) for x in out] == [("steady", 2.5)]
    assert out[0].stddev_sales == pytest.approx(1.2909944487358056)
