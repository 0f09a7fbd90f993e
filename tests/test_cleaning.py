from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pasarlens import functions as fn
from pasarlens.operators import cleaning as c
from pasarlens.schemas import SNAPSHOTS

NOON = datetime(2024, 3, 2, 12, 0, 0)


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("stock", "label"), [(0, "OUT_OF_STOCK"), (9, "LOW_STOCK"), (10, "IN_STOCK"), (None, "IN_STOCK")]
)
def test_stock_status(spark, stock, label):
    assert one(spark, stock, "bigint", fn.stock_status) == label


@pytest.mark.parametrize(
    ("discount", "label"),
    [(0.0, "No Discount"), (-5.0, "1-20%"), (19.99, "1-20%"), (20.0, "20-40%"), (40.0, "40%+"), (None, "40%+")],
)
def test_discount_range(spark, discount, label):
    assert one(spark, discount, "double", fn.discount_range) == label


@pytest.mark.parametrize(("price", "label"), [(49999.99, "LOW"), (50000.0, "MEDIUM"), (200000.0, "HIGH")])
def test_price_category(spark, price, label):
    assert one(spark, price, "double", fn.price_category) == label


@pytest.mark.parametrize(
    ("day", "weekend", "week"),
    [
        (date(2024, 12, 29), 1, date(2024, 12, 29)),  # Sunday
        (date(2024, 12, 30), 0, date(2024, 12, 29)),
        (date(2025, 1, 4), 1, date(2024, 12, 29)),  # Saturday, next year
    ],
)
def test_calendar(spark, day, weekend, week):
    assert one(spark, day, "date", fn.is_weekend) == weekend
    assert one(spark, day, "date", fn.week_start) == week


def test_strip_removes_every_white_space(spark):
    assert one(spark, "\t\n  a  b　\r\n", "string", fn.strip) == "a  b"


@pytest.mark.parametrize(("price", "discount", "net"), [(1.005, 0.0, 1.01), (10.0, None, 10.0), (99.99, 15.0, 84.99)])
def test_discounted_rounds_half_up(spark, price, discount, net):
    df = spark.createDataFrame([(price, discount)], "p double, d double")
    assert df.select(fn.discounted(F.col("p"), F.col("d"))).first()[0] == net


def snapshot(**changes):
    row = dict(
        product_id="a", product_name=" Kopi ", category=" food ", price=10.0, original_price=12.0,
        discount_percent=None, sales_count=None, rating=4.5, review_count=None, stock=None, seller_name="s",
        seller_location="l", timestamp=NOON, ingestion_date=date(2024, 3, 2),
    )
    return tuple({**row, **changes}[f.name] for f in SNAPSHOTS)


def test_clean_sales(spark):
    nullable = spark.createDataFrame([], SNAPSHOTS).schema
    for field in nullable:
        field.nullable = True
    raw = spark.createDataFrame(
        [
            snapshot(),
            snapshot(),
            snapshot(product_id=None),
            snapshot(price=0.0),
            snapshot(price=None),
            snapshot(product_id="b", ingestion_date=date(2024, 3, 1)),
        ],
        nullable,
    )
    rows = c.clean_sales(raw, date(2024, 3, 2)).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.product_name, row.category, row.discount_price, row.sales_count) == ("Kopi", "FOOD", 10.0, 0)
    assert (row.stock_status, row.sale_date, row.sale_timestamp) == ("IN_STOCK", date(2024, 3, 2), NOON)
    assert c.clean_sales(raw).count() == 2


def test_coerce_reviews_only_touches_present_columns(spark):
    df = spark.createDataFrame([("4", "2024-02-30"), ("x", "2024-02-29"), ("4.7", "")], "rating string, review_date string")
    out = c.coerce_reviews(df, date(2024, 3, 1))
    assert out.columns == ["rating", "review_date", "ingestion_date"]
    assert [(r.rating, r.review_date) for r in out.collect()] == [(4, None), (None, date(2024, 2, 29)), (4, None)]


def test_amount_uses_the_untruncated_price(spark):
    df = spark.createDataFrame([(99.0, 5.0, 10, date(2024, 1, 1))], "price double, discount_percent double, quantity bigint, sale_date date")
    row = c.derive_transactions(df).first()
    assert (row.actual_price, row.total_amount, row.sale_month, row.day_of_week) == (94, 940, "2024-01", "Monday")


def test_exact_average_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "x double")
    assert empty.agg(fn.exact_avg("x")).first()[0] is None


def test_odd_numbers_neither_stop_nor_skew(spark):
    from pasarlens.functions import discounted, exact_avg, exact_sum

    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(nan, 5.0), (5.0, nan), (inf, 1.0), (-inf, None), (1e13, 10.0), (None, 1.0), (1e300, 0.0)], "x double, d double")
    row = df.where("x <= 1e13 OR x IS NULL OR isnan(x)").agg(exact_avg("x"), exact_sum("x")).first()
    assert tuple(row) == ((1e13 + 5) / 2, 1e13 + 5)
    priced = df.where("x > 0 AND x < double('Infinity')").select(discounted(F.col("x"), F.col("d")).alias("p")).collect()
    assert sorted(p.p for p in priced) == [5.0, 9e12, 1e300]
