"""Review reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasarlens.catalog import datasets as d
from pasarlens.catalog.datasets import CREATED_AT, EVENTS_AS_OF, sql_avg
from pasarlens.operators.cleaning import coerce_reviews
from pasarlens.plans import review_reports as r


def _text_reviews(spark, sf_dir):
    """Reviews as they come from a file: all text, with some unreadable ratings and dates."""
    kind = F.col("review_text")
    rating = F.when(kind == "error", "n/a").otherwise(F.col("rating").cast("string"))
    day = F.when(kind == "signup", "2024-13-01").otherwise(F.col("review_date").cast("string"))
    return d.reviews(spark, sf_dir).select(
        "review_id",
        day.alias("review_date"),
        F.col("product_price").cast("string").alias("product_price"),
        rating.alias("rating"),
        F.col("sold_count").cast("string").alias("sold_count"),
        "sentiment_label",
    )


QUERIES = {
    "review_category_summary": lambda spark, sf: r.review_category_summary(d.reviews(spark, sf)),
    "top_rated_products": lambda spark, sf: r.top_rated_products(d.reviews(spark, sf)),
    "review_daily_trends": lambda spark, sf: r.review_daily_trends(d.reviews(spark, sf)),
    "sentiment_share": lambda spark, sf: r.sentiment_share(d.reviews(spark, sf)),
    "sentiment_analysis": lambda spark, sf: r.sentiment_analysis(d.reviews(spark, sf)),
    "sentiment_summary": lambda spark, sf: r.sentiment_summary(d.reviews(spark, sf), CREATED_AT),
    "sentiment_rollup": lambda spark, sf: r.sentiment_rollup(d.reviews(spark, sf)),
    "review_profile": lambda spark, sf: r.review_profile(d.reviews(spark, sf)),
    "coerce_reviews": lambda spark, sf: coerce_reviews(_text_reviews(spark, sf), EVENTS_AS_OF),
}

_SHARE = "round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (PARTITION BY product_category), 2)"
_AVG_RATING = "round(avg(rating), 2) AS avg_rating"


def _counted(label: str, name: str) -> str:
    return f"count(*) FILTER (WHERE sentiment_label = '{label}') AS {name}"


_SHARE_SQL = f"""
SELECT product_category, sentiment_label, count(*) AS review_count, {_AVG_RATING}, {_SHARE} AS percentage
FROM reviews GROUP BY product_category, sentiment_label"""

ORACLE = {
    "review_category_summary": f"""
WITH {d.REVIEWS_SQL}
SELECT product_category, count(DISTINCT product_id) AS total_products, count(review_id) AS total_reviews,
       {_AVG_RATING}, CAST(sum(sold_count) AS BIGINT) AS total_sold,
       round({sql_avg("product_price")}, 0) AS avg_price,
       {_counted("Positive", "positive_reviews")}, {_counted("Negative", "negative_reviews")},
       {_counted("Neutral", "neutral_reviews")}
FROM reviews GROUP BY product_category""",
    "top_rated_products": f"""
WITH {d.REVIEWS_SQL}
SELECT product_id, product_name, product_category, product_price, {_AVG_RATING},
       count(review_id) AS review_count, CAST(sum(sold_count) AS BIGINT) AS total_sold
FROM reviews GROUP BY product_id, product_name, product_category, product_price
HAVING count(review_id) >= 5
ORDER BY avg_rating DESC, review_count DESC, product_id, product_name, product_price LIMIT 100""",
    "review_daily_trends": f"""
WITH {d.REVIEWS_SQL}
SELECT review_date, count(review_id) AS total_reviews, {_AVG_RATING},
       {_counted("Positive", "positive")}, {_counted("Negative", "negative")}
FROM reviews GROUP BY review_date""",
    "sentiment_share": f"WITH {d.REVIEWS_SQL}{_SHARE_SQL}",
    "sentiment_analysis": f"""
WITH {d.REVIEWS_SQL}
SELECT product_category, sentiment_label, count(*) AS "count", {_SHARE} AS percentage
FROM reviews GROUP BY product_category, sentiment_label""",
    "sentiment_summary": f"""
WITH {d.REVIEWS_SQL}
SELECT *, TIMESTAMP '2001-08-01 03:00:00' AS created_at FROM ({_SHARE_SQL})""",
    "sentiment_rollup": f"""
WITH {d.REVIEWS_SQL}
SELECT sentiment_label, count(*) AS "count", {_AVG_RATING} FROM reviews GROUP BY sentiment_label""",
    "review_profile": f"""
WITH {d.REVIEWS_SQL},
best AS (
  SELECT product_category, count(*) AS n FROM reviews WHERE product_category IS NOT NULL
  GROUP BY product_category ORDER BY n DESC, product_category LIMIT 5
),
labels AS (
  SELECT sentiment_label, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM reviews), 1) AS percent
  FROM reviews WHERE sentiment_label IS NOT NULL GROUP BY sentiment_label
)
SELECT 'total_records' AS metric, '' AS item, CAST(count(*) AS DOUBLE) AS value FROM reviews
UNION ALL SELECT 'categories', '', CAST(count(DISTINCT product_category) AS DOUBLE) FROM reviews
UNION ALL SELECT 'avg_rating', '', round(avg(rating), 2) FROM reviews
UNION ALL SELECT 'top_category', product_category, CAST(n AS DOUBLE) FROM best
UNION ALL SELECT 'label_count', sentiment_label, CAST(n AS DOUBLE) FROM labels
UNION ALL SELECT 'label_percent', sentiment_label, CAST(percent AS DOUBLE) FROM labels""",
    "coerce_reviews": f"""
WITH {d.REVIEWS_SQL}
SELECT review_id, CASE WHEN review_text <> 'signup' THEN review_date END AS review_date, product_price,
       CASE WHEN review_text <> 'error' THEN rating END AS rating, sold_count, sentiment_label,
       DATE '2024-01-30' AS ingestion_date
FROM reviews""",
}
