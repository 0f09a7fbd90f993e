"""Reports over marketplace reviews."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pasarlens.functions import exact_avg

# The labels a review arrives with.
POSITIVE, NEGATIVE, NEUTRAL = "Positive", "Negative", "Neutral"


def _labelled(label: str) -> Column:
    return F.count_if(F.col("sentiment_label") == label)


def _avg_rating() -> Column:
    return F.round(F.avg("rating"), 2).alias("avg_rating")


def review_category_summary(reviews: DataFrame) -> DataFrame:
    return (
        reviews.groupBy("product_category")
        .agg(
            F.countDistinct("product_id").alias("total_products"),
            F.count("review_id").alias("total_reviews"),
            _avg_rating(),
            F.sum("sold_count").alias("total_sold"),
            F.round(exact_avg("product_price"), 0).alias("avg_price"),
            _labelled(POSITIVE).alias("positive_reviews"),
            _labelled(NEGATIVE).alias("negative_reviews"),
            _labelled(NEUTRAL).alias("neutral_reviews"),
        )
        .orderBy(F.desc("total_reviews"), "product_category")
    )


def top_rated_products(reviews: DataFrame, min_reviews: int = 5, limit: int = 100) -> DataFrame:
    return (
        reviews.groupBy("product_id", "product_name", "product_category", "product_price")
        .agg(
            _avg_rating(),
            F.count("review_id").alias("review_count"),
            F.sum("sold_count").alias("total_sold"),
        )
        .where(F.col("review_count") >= min_reviews)
        .orderBy(F.desc("avg_rating"), F.desc("review_count"), "product_id", "product_name", "product_price")
        .limit(limit)
    )


def review_daily_trends(reviews: DataFrame) -> DataFrame:
    return (
        reviews.groupBy("review_date")
        .agg(
            F.count("review_id").alias("total_reviews"),
            _avg_rating(),
            _labelled(POSITIVE).alias("positive"),
            _labelled(NEGATIVE).alias("negative"),
        )
        .orderBy(F.desc("review_date"))
    )


def _share_of_category(count: str) -> Column:
    """Percent of the category's reviews; the window runs over aggregated rows, one per category and label."""
    in_category = F.sum(count).over(W.partitionBy("product_category"))
    return F.round(F.col(count).cast("double") * 100 / in_category, 2)


def sentiment_share(reviews: DataFrame) -> DataFrame:
    return (
        reviews.groupBy("product_category", "sentiment_label")
        .agg(F.count("*").alias("review_count"), _avg_rating())
        .withColumn("percentage", _share_of_category("review_count"))
        .orderBy("product_category", F.desc("review_count"), "sentiment_label")
    )


def sentiment_analysis(reviews: DataFrame) -> DataFrame:
    return (
        reviews.groupBy("product_category", "sentiment_label")
        .agg(F.count("*").alias("count"))
        .withColumn("percentage", _share_of_category("count"))
        .orderBy("product_category", F.desc("count"), "sentiment_label")
    )


def sentiment_summary(reviews: DataFrame, created_at: datetime) -> DataFrame:
    """The stored form of ``sentiment_share``."""
    return sentiment_share(reviews).withColumn("created_at", F.lit(created_at).cast("timestamp_ntz"))


def sentiment_rollup(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("sentiment_label").agg(F.count("*").alias("count"), _avg_rating())


def review_profile(reviews: DataFrame, top: int = 5) -> DataFrame:
    """Profile of a review load as (metric, item, value) rows, from one scan.

    The reviews are reduced to one row per (category, label) before the per-category, per-label and overall
    totals are taken, so the windows below run over a handful of rows. Rows without a category or label count
    towards the total but are not listed.
    """
    cells = reviews.groupBy("product_category", "sentiment_label").agg(
        F.count("*").alias("n"), F.sum("rating").alias("rating_sum"), F.count("rating").alias("rated")
    )
    category, label = F.col("product_category"), F.col("sentiment_label")
    levels = cells.groupingSets([[category], [label], []], category, label).agg(
        F.grouping("product_category").alias("no_category"),
        F.grouping("sentiment_label").alias("no_label"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.countDistinct("product_category").cast("double").alias("categories"),
        F.round(F.try_divide(F.sum("rating_sum"), F.sum("rated")), 2).alias("avg_rating"),
    )
    level = W.partitionBy("no_category", "no_label")
    by_size = level.orderBy(category.isNull(), F.desc("n"), category)
    ranked = levels.select(
        "*",
        F.row_number().over(by_size).alias("place"),
        F.round(F.col("n").cast("double") * 100 / F.sum("n").over(level), 1).alias("percent"),
    )

    def entry(metric: str, item: Column, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), item.alias("item"), value.cast("double").alias("value"))

    none, n = F.lit(""), F.col("n")
    overall = (F.col("no_category") == 1) & (F.col("no_label") == 1)
    one_category = (F.col("no_category") == 0) & category.isNotNull() & (F.col("place") <= top)
    one_label = (F.col("no_label") == 0) & label.isNotNull()
    entries = (
        F.when(
            overall,
            F.array(
                entry("total_records", none, n),
                entry("categories", none, F.col("categories")),
                entry("avg_rating", none, F.col("avg_rating")),
            ),
        )
        .when(one_category, F.array(entry("top_category", category, n)))
        .when(one_label, F.array(entry("label_count", label, n), entry("label_percent", label, F.col("percent"))))
    )
    return ranked.select(F.inline(entries))
