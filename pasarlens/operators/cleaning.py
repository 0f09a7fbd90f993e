"""Cleaning of snapshots, transactions and reviews."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.functions import discounted, is_finite, month_text, stock_status, strip, weekday_name


def clean_sales(
    raw: DataFrame, day: date | None = None, keep: Sequence[str] = (), gather: Sequence[str] = ()
) -> DataFrame:
    """Cleaned, distinct snapshot rows with a positive, finite price; ``day`` restricts the run to one ingestion day.

    ``keep`` columns stay beside the row and count towards its distinctness. Rows are dealt out by
    ``gather``, if given, and not by the whole row: then grouping by more than these columns needs no other shuffle, but equal rows are
    not merged before they are dealt out. The discounted price, which follows from other columns, is then added to the distinct rows.
    """
    if day is not None:
        raw = raw.where(F.col("ingestion_date") == F.lit(day))
    rows = (
        raw.where((F.col("price") > 0) & is_finite("price") & F.col("product_id").isNotNull())
        .select(
            *keep,
            "product_id",
            strip(F.col("product_name")).alias("product_name"),
            F.upper(strip(F.col("category"))).alias("category"),
            "price",
            "discount_percent",
            F.coalesce("sales_count", F.lit(0)).alias("sales_count"),
            "rating",
            F.coalesce("review_count", F.lit(0)).alias("review_count"),
            stock_status(F.col("stock")).alias("stock_status"),
            "seller_name",
            "seller_location",
            F.to_date("timestamp").alias("sale_date"),
            F.col("timestamp").alias("sale_timestamp"),
        )
    )
    price = discounted(F.col("price"), F.col("discount_percent")).alias("discount_price")
    place = rows.columns.index("discount_percent")
    columns = [*rows.columns[:place], price, *rows.columns[place:]]
    if gather:
        return rows.repartition(*gather).distinct().select(*columns)
    return rows.select(*columns).distinct()


def rebuild_sale_days(raw: DataFrame, day: date) -> DataFrame:
    """All cleaned rows of the sale days an ingestion day touches, also those other ingestion days brought.

    Replacing those days by this result repeats a run without losing or doubling rows. The day list is broadcast:
    it holds at most one row per calendar day.
    """
    touched = raw.where(F.col("ingestion_date") == F.lit(day)).select(F.to_date("timestamp").alias("_day")).distinct()
    same_days = raw.join(F.broadcast(touched), F.to_date(raw["timestamp"]) == touched["_day"], "left_semi")
    return clean_sales(same_days, keep=["ingestion_date"]).drop("ingestion_date")


def coerce_reviews(reviews: DataFrame, as_of: date) -> DataFrame:
    """Read numbers and dates from text, unreadable ones as null; columns that are absent stay absent."""
    coerced = {
        "product_price": F.col("product_price").try_cast("double"),
        "rating": F.col("rating").try_cast("double").cast("bigint"),
        "sold_count": F.col("sold_count").try_cast("double").cast("bigint"),
        "review_date": F.col("review_date").try_cast("date"),
    }
    present = {name: column for name, column in coerced.items() if name in reviews.columns}
    return reviews.withColumns({**present, "ingestion_date": F.lit(as_of)})


def derive_transactions(sales: DataFrame) -> DataFrame:
    """Whole-unit net price and amount, sale month and weekday.

    The amount comes from the untruncated net price, so it can exceed ``actual_price * quantity``.
    """
    net = F.col("price") * (1 - F.col("discount_percent") / 100)
    return sales.withColumns(
        {
            "actual_price": net.cast("bigint"),
            "total_amount": (net * F.col("quantity")).cast("bigint"),
            "sale_month": month_text("sale_date"),
            "day_of_week": weekday_name("sale_date"),
        }
    )


def enrich_sales(transactions: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Give each transaction its product's name, category, price and seller.

    No broadcast hint: the catalogue is broadcast while its measured size is below
    ``spark.sql.autoBroadcastJoinThreshold``; a larger one is shuffled, with skewed products split at run time.
    """
    described = catalogue.select("product_id", "product_name", "category", "price", "seller_name", "seller_location")
    return derive_transactions(transactions.join(described, "product_id"))
