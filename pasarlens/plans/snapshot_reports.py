"""Reports over cleaned product snapshots, the job log, and table health."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasarlens.functions import as_exact, discount_range, exact_avg, exact_stddev, exact_sum, in_window, week_start


def daily_totals(raw: DataFrame) -> DataFrame:
    """Per ingestion day: revenue, units, mean price and the category with most units.

    Two aggregation levels: per (day, category) with map-side partials, then per day over one row per category.
    A day may hold any share of the rows without one task having to see them all.
    """
    per_category = raw.groupBy("ingestion_date", "category").agg(
        F.sum(as_exact("revenue")).alias("revenue"),
        F.sum("sales_count").alias("units"),
        F.sum(as_exact("price")).alias("price_sum"),
        F.count(as_exact("price")).alias("priced"),
    )
    best = F.min(F.struct(F.col("units").isNull(), -F.col("units"), "category"))
    return per_category.groupBy(F.col("ingestion_date").alias("summary_date")).agg(
        F.sum("revenue").cast("double").alias("total_sales"),
        F.sum("units").alias("total_quantity"),
        F.try_divide(F.sum("price_sum").cast("double"), F.sum("priced")).alias("avg_price"),
        best["category"].alias("top_category"),
    )


def daily_summary_snapshot(raw: DataFrame, day: date) -> DataFrame:
    """The row of one day; an empty day still gives a row, without values."""
    totals = daily_totals(raw.where(F.col("ingestion_date") == F.lit(day))).drop("summary_date")
    row = totals.agg(*[F.max(c).alias(c) for c in totals.columns])
    return row.select(F.lit(day).alias("summary_date"), *totals.columns)


def daily_category_summary(cleaned: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return (
        cleaned.where(in_window("sale_date", as_of, days=days))
        .groupBy(F.col("sale_date").alias("summary_date"), "category")
        .agg(
            F.countDistinct("product_id").alias("unique_products"),
            F.count("*").alias("total_records"),
            F.sum("sales_count").alias("total_sales"),
            exact_avg("price").alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            exact_avg("discount_percent").alias("avg_discount"),
            exact_avg("rating").alias("avg_rating"),
        )
    )


def scheduled_rollup(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("sale_date", "category").agg(
        F.count("*").alias("count"), F.sum("sales_count").alias("total_sales")
    )


def product_performance(cleaned: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return (
        cleaned.where(in_window("sale_date", as_of, days=days))
        .groupBy("product_id", "product_name", "category")
        .agg(
            exact_avg("price").alias("avg_price"),
            F.sum("sales_count").alias("total_sales"),
            exact_avg("rating").alias("avg_rating"),
            F.count("*").alias("days_available"),
            F.max("sale_date").alias("last_sale_date"),
        )
        .where(F.col("total_sales") > 0)
    )


def summary_stats(cleaned: DataFrame, day: date) -> DataFrame:
    return cleaned.where(F.col("sale_date") == F.lit(day)).agg(
        F.countDistinct("product_id").alias("unique_products"),
        F.count("*").alias("total_records"),
        exact_avg("price").alias("avg_price"),
        F.sum("sales_count").alias("total_sales"),
    )


def best_categories(cleaned: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return (
        cleaned.where(in_window("sale_date", as_of, days=days))
        .groupBy("category")
        .agg(
            F.sum("sales_count").alias("total_sales"),
            exact_avg("price").alias("avg_price"),
            F.countDistinct("product_id").alias("num_products"),
        )
        .orderBy(F.desc("total_sales"), "category")
    )


def weekly_trend(cleaned: DataFrame, as_of: date, weeks: int = 8, min_weeks: int = 4, limit: int = 20) -> DataFrame:
    """Products that sold in enough weeks, by mean weekly units. Weeks start on Sunday."""
    weekly = (
        cleaned.where(in_window("sale_date", as_of, weeks=weeks))
        .groupBy("product_name", week_start("sale_date").alias("week"))
        .agg(F.sum("sales_count").alias("units"))
    )
    units = F.col("units").cast("decimal(18,0)")
    return (
        weekly.groupBy("product_name")
        .agg(
            F.count("*").alias("weeks"),
            F.avg("units").alias("avg_weekly_sales"),
            exact_stddev(F.count("units"), F.sum(units), F.sum(units * units)).alias("stddev_sales"),
        )
        .where(F.col("weeks") >= min_weeks)
        .drop("weeks")
        .orderBy(F.desc("avg_weekly_sales"), "product_name")
        .limit(limit)
    )


def discount_effectiveness(cleaned: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return (
        cleaned.where(in_window("sale_date", as_of, days=days))
        .groupBy(discount_range(F.col("discount_percent")).alias("discount_range"))
        .agg(F.avg("sales_count").alias("avg_sales"), F.count("*").alias("num_products"))
        .orderBy(F.desc("avg_sales"), "discount_range")
    )


def top_products_week(cleaned: DataFrame, as_of: date, days: int = 7, limit: int = 10) -> DataFrame:
    return (
        cleaned.where(in_window("sale_date", as_of, days=days))
        .groupBy("product_name")
        .agg(F.sum("sales_count").alias("total_sales"))
        .orderBy(F.desc("total_sales"), "product_name")
        .limit(limit)
    )


def category_counts(cleaned: DataFrame, limit: int | None = 5) -> DataFrame:
    """Rows per category, largest first; all categories when ``limit`` is None."""
    counts = cleaned.groupBy("category").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "category")
    return counts if limit is None else counts.limit(limit)


def daily_sales_last30(category_summary: DataFrame, limit: int = 30) -> DataFrame:
    """Units per day, the newest days of a stored category summary."""
    return (
        category_summary.groupBy("summary_date")
        .agg(F.sum("total_sales").alias("daily_sales"))
        .orderBy(F.desc("summary_date"))
        .limit(limit)
    )


def top_products(performance: DataFrame, limit: int = 10) -> DataFrame:
    return (
        performance.orderBy(F.desc("total_sales"), "product_id", "product_name", "category")
        .limit(limit)
        .select("product_name", "total_sales", "avg_rating")
    )


def dash_category(category_summary: DataFrame) -> DataFrame:
    return category_summary.groupBy("category").agg(F.sum("total_sales").alias("total_sales"))


def dash_trend(category_summary: DataFrame) -> DataFrame:
    return category_summary.groupBy("summary_date").agg(F.sum("total_sales").alias("total_sales"))


def dash_price(category_summary: DataFrame) -> DataFrame:
    return category_summary.groupBy("category").agg(exact_avg("avg_price", 8).alias("avg_price"))


def dash_products(performance: DataFrame) -> DataFrame:
    return performance.select("product_name", "category", "total_sales", "avg_rating")


def price_category_by_product(cleaned: DataFrame, label: Column) -> DataFrame:
    """Mean price per product with its label (``label`` is an expression over ``avg_price``)."""
    prices = cleaned.groupBy("product_id").agg(exact_avg("price").alias("avg_price"))
    return prices.withColumn("price_category", label)


def job_cost_report(job_log: DataFrame, as_of: date, days: int = 7, limit: int = 10) -> DataFrame:
    """The most expensive jobs of the last days; 5 USD per billed terabyte."""
    recent = F.col("creation_time") >= F.date_sub(F.lit(as_of), days).cast("timestamp_ntz")
    return (
        job_log.where(recent)
        .orderBy(F.desc("total_bytes_billed"), "user_email", "query", "total_bytes_processed")
        .limit(limit)
        .select(
            "user_email",
            "query",
            (F.col("total_bytes_processed") / 1e9).alias("gb_processed"),
            (F.col("total_bytes_billed") / 1e9 * 5 / 1000).alias("estimated_cost_usd"),
        )
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def freshness(cleaned: DataFrame) -> DataFrame:
    """The newest sale date."""
    return cleaned.agg(F.max("sale_date").alias("latest"))


def window_totals(sales: DataFrame, as_of: date, windows: dict[str, dict[str, int]]) -> DataFrame:
    """Rows and revenue of several look-back windows as (window, rows, revenue), in one scan of the longest."""
    tests = {name: in_window("sale_date", as_of, **length) for name, length in windows.items()}
    any_window = reduce(lambda a, b: a | b, tests.values())
    amount = F.col("total_amount")
    totals = sales.where(any_window).agg(
        *[F.count_if(test).alias(f"{name}_rows") for name, test in tests.items()],
        *[exact_sum(F.when(test, amount)).alias(f"{name}_revenue") for name, test in tests.items()],
    )
    rows = ", ".join(f"'{name}', `{name}_rows`, `{name}_revenue`" for name in tests)
    return totals.selectExpr(f"stack({len(tests)}, {rows}) as (window, rows, revenue)")
