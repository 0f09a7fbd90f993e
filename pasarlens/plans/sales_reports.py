"""Reports over sales transactions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.functions import as_exact, exact_avg, exact_sum


def category_sales(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("category")
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            F.sum("quantity").alias("total_quantity"),
            exact_sum("total_amount").alias("total_revenue"),
            F.round(exact_avg("actual_price"), 0).alias("avg_price"),
            F.countDistinct("seller_name").alias("unique_sellers"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def top_sellers(sales: DataFrame, limit: int = 100) -> DataFrame:
    return (
        sales.groupBy("seller_name", "seller_location")
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            exact_sum("total_amount").alias("total_revenue"),
            F.countDistinct("category").alias("categories_sold"),
        )
        .orderBy(F.desc("total_revenue"), "seller_name", "seller_location")
        .limit(limit)
    )


def daily_sales_trends(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("sale_date")
        .agg(
            F.count("transaction_id").alias("transactions"),
            exact_sum("total_amount").alias("revenue"),
            F.round(exact_avg("total_amount"), 0).alias("avg_order_value"),
        )
        .orderBy(F.desc("sale_date"))
    )


def daily_summary(sales: DataFrame, created_at: datetime) -> DataFrame:
    """One row per day with the category and product of the day's largest transaction.

    The largest transaction is the minimum of one struct, so it is found by the same aggregate as the sums: a hot
    day ships one candidate per task, never its rows. Equal amounts are decided by transaction and product id.
    Sellers are counted apart, from two columns: a distinct count beside the struct would send the wide struct
    through the shuffle once per day and seller.
    """
    amount = F.col("total_amount")
    largest = F.min(F.struct(amount.isNull(), -amount, "transaction_id", "product_id", "category", "product_name"))
    measures = sales.groupBy(F.col("sale_date").alias("summary_date")).agg(
        F.count("transaction_id").alias("total_transactions"),
        exact_sum("total_amount").alias("total_revenue"),
        F.sum("quantity").alias("total_quantity"),
        F.round(exact_avg("total_amount"), 0).alias("avg_order_value"),
        largest.alias("largest"),
    )
    sellers = sales.groupBy("sale_date").agg(F.countDistinct("seller_name").alias("unique_sellers"))
    return measures.join(sellers, measures["summary_date"].eqNullSafe(sellers["sale_date"])).select(
        "summary_date",
        "total_transactions",
        "total_revenue",
        "total_quantity",
        "avg_order_value",
        F.col("largest.category").alias("top_category"),
        F.col("largest.product_name").alias("top_product"),
        "unique_sellers",
        F.lit(created_at).cast("timestamp_ntz").alias("created_at"),
    )


def summary_preview(summary: DataFrame, limit: int = 10) -> DataFrame:
    """The newest summary rows."""
    return summary.orderBy(F.desc("summary_date")).limit(limit)


def summary_sample(summary: DataFrame, limit: int = 100, key: str = "summary_date") -> DataFrame:
    """The rows whose keys have the smallest MD5 digests: a sample that looks random, is the same on every run and is merged from the
    smallest of each task. A null key has the digest of the empty text."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return summary.orderBy(digest, key).limit(limit)


def category_revenue(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("category")
        .agg(F.count("*").alias("transactions"), exact_sum("total_amount").alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


def transaction_profile(sales: DataFrame) -> DataFrame:
    """One row: products, transactions, categories and revenue of a load.

    Grouping by product and category first leaves one row per pair for the two distinct counts, where counting
    both on the raw rows would copy every row once per count.
    """
    pairs = sales.groupBy("product_id", "category").agg(
        F.count("*").alias("rows"), F.sum(as_exact("total_amount")).alias("amount")
    )
    return pairs.agg(
        F.countDistinct("product_id").alias("total_products"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_transactions"),
        F.countDistinct("category").alias("categories"),
        F.sum("amount").cast("double").alias("total_revenue"),
    )
