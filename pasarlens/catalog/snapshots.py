"""Snapshot cleaning, reports, quality rules and features."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from pasarlens.catalog import datasets as d
from pasarlens.catalog.datasets import AS_OF, EVENTS_AS_OF, sql_avg, sql_sum
from pasarlens.functions import discounted, exact_avg, price_category, stock_status
from pasarlens.operators import quality as q
from pasarlens.operators.cleaning import clean_sales
from pasarlens.operators.records import coerce_types, normalize_records, quarantine, to_records, validate_required
from pasarlens.plans import features as f
from pasarlens.plans import models as m
from pasarlens.plans import snapshot_reports as r
from pasarlens.session import fresh_path

Z_LIMIT = 1.7  # the given prices are spread evenly, so none lies three deviations from its category's mean


def _records(spark, sf_dir):
    """Snapshots as JSON records; the missing ids and prices become missing keys."""
    return to_records(d.snapshots(spark, sf_dir).drop("ingestion_date").withColumn("sid", F.lit("snapshot")), "sid")


def with_revenue(spark, sf_dir):
    return d.snapshots(spark, sf_dir).withColumn("revenue", F.col("price") * F.col("sales_count"))


def _by_category(spark, sf_dir):
    return r.daily_category_summary(d.cleaned(spark, sf_dir), AS_OF)


def _performance(spark, sf_dir):
    return r.product_performance(d.cleaned(spark, sf_dir), AS_OF)


def _rules(spark, sf_dir):
    return q.run_rules(d.snapshots(spark, sf_dir), q.standard_rules())


def _health_tables(spark, sf_dir):
    cleaned = d.cleaned(spark, sf_dir)
    return {
        "raw_sales_data": d.snapshots(spark, sf_dir),
        "cleaned_sales_data": cleaned,
        "daily_summary": r.daily_category_summary(cleaned, AS_OF),
    }


def _text(field: str):
    return F.try_variant_get("record", f"$.{field}", "string").alias(field)


#: Days up to which the features are brought forward, one step after the other.
FEATURE_STEPS = (date(1997, 1, 1), date(2001, 6, 1), date(2001, 6, 8), date(2100, 1, 1))


def incremental_features(spark, sf):
    """Features brought forward in steps, each from the step before and its own days. A step cleans its own snapshots only; their day is
    tested first, before prices are reckoned, and rows are dealt out by product and day, by which the features group them."""
    root, since = fresh_path(spark, "features"), None
    raw, day = d.snapshots(spark, sf), F.to_date("timestamp")
    for until in FEATURE_STEPS:
        own = raw.where(day <= F.lit(until)) if since is None else raw.where((day <= F.lit(until)) & (day > F.lit(since)))
        f.advance_features(clean_sales(own, gather=("product_id", "sale_date")), root, since, until)
        since = until
    return f.advanced_features(spark, root).where("sales_lag_1 IS NOT NULL")


QUERIES = {
    "incremental_features": incremental_features,
    "validate_required": lambda spark, sf: validate_required(_records(spark, sf)).select(
        *[_text(c) for c in ("product_id", "product_name", "category", "seller_name")]
    ),
    "quarantine": lambda spark, sf: quarantine(_records(spark, sf)).select(
        _text("product_id"), _text("product_name"), _text("seller_name"), "reason"
    ),
    "coerce_types": lambda spark, sf: coerce_types(_records(spark, sf)).select(
        _text("product_id"), "price", "sales_count"
    ),
    "normalize_records": lambda spark, sf: normalize_records(_records(spark, sf), AS_OF),
    "clean_sales": lambda spark, sf: d.cleaned(spark, sf),
    "stock_status": lambda spark, sf: d.snapshots(spark, sf)
    .groupBy(stock_status(F.col("stock")).alias("stock_status"))
    .agg(F.count("*").alias("rows"), F.sum("stock").cast("bigint").alias("units_in_stock")),
    "discount_price": lambda spark, sf: d.snapshots(spark, sf)
    .select(
        "product_id",
        "price",
        "discount_percent",
        discounted(F.col("price"), F.col("discount_percent")).alias("discount_price"),
    )
    .where(F.col("price") > 0),
    "price_category": lambda spark, sf: r.price_category_by_product(
        d.cleaned(spark, sf), price_category(F.col("avg_price"))
    ),
    "daily_summary_snapshot": lambda spark, sf: r.daily_summary_snapshot(with_revenue(spark, sf), AS_OF),
    "daily_totals": lambda spark, sf: r.daily_totals(with_revenue(spark, sf)),
    "daily_category_summary": _by_category,
    "scheduled_rollup": lambda spark, sf: r.scheduled_rollup(d.cleaned(spark, sf)),
    "product_performance": _performance,
    "summary_stats": lambda spark, sf: r.summary_stats(d.cleaned(spark, sf), AS_OF),
    "best_categories": lambda spark, sf: r.best_categories(d.cleaned(spark, sf), AS_OF),
    "weekly_trend": lambda spark, sf: r.weekly_trend(d.cleaned(spark, sf), AS_OF),
    "discount_effectiveness": lambda spark, sf: r.discount_effectiveness(d.cleaned(spark, sf), AS_OF),
    "top_products_week": lambda spark, sf: r.top_products_week(d.cleaned(spark, sf), AS_OF),
    "category_counts": lambda spark, sf: r.category_counts(d.cleaned(spark, sf)),
    "daily_sales_last30": lambda spark, sf: r.daily_sales_last30(_by_category(spark, sf)),
    "top_products": lambda spark, sf: r.top_products(_performance(spark, sf)),
    "job_cost_report": lambda spark, sf: r.job_cost_report(d.job_log(spark, sf), EVENTS_AS_OF),
    "dash_category": lambda spark, sf: r.dash_category(_by_category(spark, sf)),
    "dash_trend": lambda spark, sf: r.dash_trend(_by_category(spark, sf)),
    "dash_price": lambda spark, sf: r.dash_price(_by_category(spark, sf)),
    "dash_products": lambda spark, sf: r.dash_products(_performance(spark, sf)),
    "table_counts": lambda spark, sf: r.table_counts(_health_tables(spark, sf)),
    "freshness": lambda spark, sf: r.freshness(d.cleaned(spark, sf)),
    "check_negative_prices": lambda spark, sf: q.run_rules(d.snapshots(spark, sf), q.negative_prices()),
    "check_null_ids": lambda spark, sf: q.run_rules(d.snapshots(spark, sf), q.null_product_ids()),
    "quality_score": lambda spark, sf: q.quality_score(_rules(spark, sf)),
    "raw_duplicates": lambda spark, sf: q.raw_duplicates(d.snapshots(spark, sf)),
    "raw_nulls": lambda spark, sf: q.raw_nulls(d.snapshots(spark, sf)),
    "quality_report": lambda spark, sf: q.quality_report(d.snapshots(spark, sf)),
    "sales_lags": lambda spark, sf: f.sales_lags(f.product_days(d.cleaned(spark, sf))),
    "moving_averages": lambda spark, sf: f.moving_averages(f.product_days(d.cleaned(spark, sf))),
    "ml_features": lambda spark, sf: f.ml_features(d.cleaned(spark, sf)),
    "calendar_features": lambda spark, sf: f.calendar_features(d.cleaned(spark, sf)),
    "seq_split": lambda spark, sf: f.seq_split(f.ml_features(d.cleaned(spark, sf))).select(
        "product_id", "product_name", "category", "sale_date", "daily_sales", "is_eval"
    ),
    "cluster_features": lambda spark, sf: m.cluster_features(d.cleaned(spark, sf), AS_OF),
    "finite_prices": lambda spark, sf: clean_sales(d.odd_snapshots(spark, sf)).groupBy("category").agg(
        F.count("*").alias("rows"), exact_avg("price").alias("avg_price"), F.max("price").alias("max_price"),
        F.max("discount_price").alias("max_discount_price"),
    ),
    "price_zscore": lambda spark, sf: m.price_zscore(d.cleaned(spark, sf), Z_LIMIT),
}

_SINCE = "sale_date BETWEEN DATE '2001-08-01' - {} AND DATE '2001-08-01'"
_DAYS_30 = _SINCE.format(30)
_PRESENT = "product_id IS NOT NULL AND price IS NOT NULL"

_BY_CATEGORY_SQL = f"""
by_category AS (
  SELECT sale_date AS summary_date, category, count(DISTINCT product_id) AS unique_products,
         count(*) AS total_records, CAST(sum(sales_count) AS BIGINT) AS total_sales,
         {sql_avg("price")} AS avg_price, min(price) AS min_price, max(price) AS max_price,
         {sql_avg("discount_percent")} AS avg_discount, {sql_avg("rating")} AS avg_rating
  FROM cleaned WHERE {_DAYS_30} GROUP BY sale_date, category
)"""

PERFORMANCE_SQL = f"""
performance AS (
  SELECT product_id, product_name, category, {sql_avg("price")} AS avg_price,
         CAST(sum(sales_count) AS BIGINT) AS total_sales, {sql_avg("rating")} AS avg_rating,
         count(*) AS days_available, max(sale_date) AS last_sale_date
  FROM cleaned WHERE {_DAYS_30} GROUP BY product_id, product_name, category HAVING sum(sales_count) > 0
)"""

PER_DAY_SQL = """
per_category AS (
  SELECT ingestion_date, category, sum(CAST(price * sales_count AS DECIMAL(28,6))) AS revenue,
         sum(sales_count) AS units, sum(CAST(price AS DECIMAL(28,6))) AS price_sum, count(price) AS priced,
         row_number() OVER (PARTITION BY ingestion_date ORDER BY sum(sales_count) DESC NULLS LAST, category) AS place
  FROM snapshots GROUP BY ingestion_date, category
),
per_day AS (
  SELECT ingestion_date AS summary_date, CAST(sum(revenue) AS DOUBLE) AS total_sales,
         CAST(sum(units) AS BIGINT) AS total_quantity,
         CAST(sum(price_sum) AS DOUBLE) / nullif(sum(priced), 0) AS avg_price,
         max(category) FILTER (WHERE place = 1) AS top_category
  FROM per_category GROUP BY ingestion_date
)"""

_DAYS_SQL = """
days AS (
  SELECT product_id, product_name, category, sale_date, CAST(sum(sales_count) AS BIGINT) AS daily_sales
  FROM cleaned GROUP BY product_id, product_name, category, sale_date
)"""

_HISTORY = "PARTITION BY product_id ORDER BY sale_date, product_name, category"


def _lag(n: int) -> str:
    return f"lag(daily_sales, {n}) OVER ({_HISTORY}) AS sales_lag_{n}"


def _mean(n: int) -> str:
    return f"avg(daily_sales) OVER ({_HISTORY} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS sales_ma_{n}"


_PRODUCT_DAY = f"""product_id, product_name, category, sale_date, {sql_avg("price")} AS avg_price,
         {sql_avg("discount_percent")} AS avg_discount, CAST(sum(sales_count) AS BIGINT) AS daily_sales,
         {sql_avg("rating")} AS avg_rating"""
_WEEKDAY = "CAST(dayofweek(sale_date) + 1 AS INTEGER) AS day_of_week, CAST(month(sale_date) AS INTEGER) AS month"
_WEEKEND = "CASE WHEN dayofweek(sale_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend"

FEATURES_SQL = f"""
daily AS (
  SELECT {_PRODUCT_DAY}, max(review_count) AS review_count, {_WEEKDAY}, {_WEEKEND},
         CAST(day(sale_date) AS INTEGER) AS day_of_month, CAST(year(sale_date) AS INTEGER) AS year,
         CASE WHEN {sql_avg("price")} < 50000 THEN 'LOW' WHEN {sql_avg("price")} < 200000 THEN 'MEDIUM'
              ELSE 'HIGH' END AS price_category
  FROM cleaned GROUP BY product_id, product_name, category, sale_date
),
history AS (SELECT *, {_lag(1)}, {_lag(7)}, {_lag(30)}, {_mean(7)}, {_mean(30)} FROM daily),
features AS (SELECT * FROM history WHERE sales_lag_1 IS NOT NULL)"""

_RULE_COUNTS = """
broken AS (
  SELECT 'negative_prices' AS check_name, count(*) FILTER (WHERE price < 0) AS bad_rows FROM snapshots
  UNION ALL
  SELECT 'null_product_ids', count(*) FILTER (WHERE product_id IS NULL) FROM snapshots
)"""

_GROUPS = "(SELECT count(*) AS copies FROM snapshots GROUP BY product_id, \"timestamp\")"

ORACLE = {
    "finite_prices": f"""
WITH {d.ODD_SNAPSHOTS_SQL},
kept AS (
  SELECT DISTINCT product_id, category, "timestamp", price, discount_percent,
         CASE WHEN price < 1e12 THEN CAST(round(CAST(price AS DECIMAL(20,6)) * (100 - CAST(discount_percent AS DECIMAL(9,6)))
                                                * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE)
              ELSE price * (100 - discount_percent) / 100 END AS discount_price
  FROM odd_snapshots WHERE price > 0 AND isfinite(price)
)
SELECT category, count(*) AS "rows", {sql_avg("price")} AS avg_price, max(price) AS max_price,
       max(discount_price) AS max_discount_price
FROM kept GROUP BY category""",
    "validate_required": f"""
WITH {d.SNAPSHOTS_SQL}
SELECT product_id, product_name, category, seller_name FROM snapshots WHERE {_PRESENT}""",
    "quarantine": f"""
WITH {d.SNAPSHOTS_SQL}
SELECT product_id, product_name, seller_name, 'missing key' AS reason FROM snapshots WHERE NOT ({_PRESENT})""",
    "coerce_types": f"""
WITH {d.SNAPSHOTS_SQL} SELECT product_id, coalesce(price, 0) AS price, sales_count FROM snapshots""",
    "normalize_records": f"""
WITH {d.SNAPSHOTS_SQL}
SELECT coalesce(product_id, '') AS product_id, product_name, category, coalesce(price, 0) AS price, original_price,
       CAST(discount_percent AS BIGINT) AS discount_percent, sales_count, rating, review_count, stock, seller_name,
       seller_location, DATE '2001-08-01' AS ingestion_date, DATE '2001-08-01' AS sale_date,
       coalesce(price, 0) * sales_count AS revenue
FROM snapshots""",
    "clean_sales": f"WITH {d.CLEANED_SQL} SELECT * FROM cleaned",
    "stock_status": f"""
WITH {d.SNAPSHOTS_SQL}
SELECT CASE WHEN stock = 0 THEN 'OUT_OF_STOCK' WHEN stock < 10 THEN 'LOW_STOCK' ELSE 'IN_STOCK' END AS stock_status,
       count(*) AS "rows", CAST(sum(stock) AS BIGINT) AS units_in_stock
FROM snapshots GROUP BY 1""",
    "discount_price": f"""
WITH {d.SNAPSHOTS_SQL}
SELECT product_id, price, discount_percent,
       CAST(round(CAST(price AS DECIMAL(20,6)) * (100 - CAST(coalesce(discount_percent, 0) AS DECIMAL(9,6)))
                  * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE) AS discount_price
FROM snapshots WHERE price > 0""",
    "price_category": f"""
WITH {d.CLEANED_SQL},
prices AS (SELECT product_id, {sql_avg("price")} AS avg_price FROM cleaned GROUP BY product_id)
SELECT *, CASE WHEN avg_price < 50000 THEN 'LOW' WHEN avg_price < 200000 THEN 'MEDIUM' ELSE 'HIGH' END
       AS price_category FROM prices""",
    "daily_summary_snapshot": f"""
WITH {d.SNAPSHOTS_SQL}, {PER_DAY_SQL}
SELECT x.summary_date, total_sales, total_quantity, avg_price, top_category
FROM (SELECT DATE '2001-08-01' AS summary_date) x LEFT JOIN per_day ON x.summary_date = per_day.summary_date""",
    "daily_totals": f"WITH {d.SNAPSHOTS_SQL}, {PER_DAY_SQL} SELECT * FROM per_day",
    "daily_category_summary": f"WITH {d.CLEANED_SQL}, {_BY_CATEGORY_SQL} SELECT * FROM by_category",
    "scheduled_rollup": f"""
WITH {d.CLEANED_SQL}
SELECT sale_date, category, count(*) AS "count", CAST(sum(sales_count) AS BIGINT) AS total_sales
FROM cleaned GROUP BY sale_date, category""",
    "product_performance": f"WITH {d.CLEANED_SQL}, {PERFORMANCE_SQL} SELECT * FROM performance",
    "summary_stats": f"""
WITH {d.CLEANED_SQL}
SELECT count(DISTINCT product_id) AS unique_products, count(*) AS total_records, {sql_avg("price")} AS avg_price,
       CAST(sum(sales_count) AS BIGINT) AS total_sales
FROM cleaned WHERE sale_date = DATE '2001-08-01'""",
    "best_categories": f"""
WITH {d.CLEANED_SQL}
SELECT category, CAST(sum(sales_count) AS BIGINT) AS total_sales, {sql_avg("price")} AS avg_price,
       count(DISTINCT product_id) AS num_products
FROM cleaned WHERE {_DAYS_30} GROUP BY category""",
    "weekly_trend": f"""
WITH {d.CLEANED_SQL},
weekly AS (
  SELECT product_name, CAST(sale_date - CAST(dayofweek(sale_date) AS INTEGER) AS DATE) AS week,
         sum(sales_count) AS units
  FROM cleaned WHERE {_SINCE.format(56)} GROUP BY 1, 2
)
SELECT product_name, CAST(sum(units) AS DOUBLE) / count(*) AS avg_weekly_sales,
       sqrt(CAST(count(*) * sum(units * units) - sum(units) * sum(units) AS DOUBLE)
            / nullif(count(*) * (count(*) - 1), 0)) AS stddev_sales
FROM weekly GROUP BY product_name HAVING count(*) >= 4
ORDER BY avg_weekly_sales DESC, product_name LIMIT 20""",
    "discount_effectiveness": f"""
WITH {d.CLEANED_SQL}
SELECT CASE WHEN discount_percent = 0 THEN 'No Discount' WHEN discount_percent < 20 THEN '1-20%'
            WHEN discount_percent < 40 THEN '20-40%' ELSE '40%+' END AS discount_range,
       CAST(sum(sales_count) AS DOUBLE) / count(*) AS avg_sales, count(*) AS num_products
FROM cleaned WHERE {_DAYS_30} GROUP BY 1""",
    "top_products_week": f"""
WITH {d.CLEANED_SQL}
SELECT product_name, CAST(sum(sales_count) AS BIGINT) AS total_sales
FROM cleaned WHERE {_SINCE.format(7)} GROUP BY product_name ORDER BY total_sales DESC, product_name LIMIT 10""",
    "category_counts": f"""
WITH {d.CLEANED_SQL}
SELECT category, count(*) AS "count" FROM cleaned GROUP BY category ORDER BY 2 DESC, 1 LIMIT 5""",
    "daily_sales_last30": f"""
WITH {d.CLEANED_SQL}, {_BY_CATEGORY_SQL}
SELECT summary_date, CAST(sum(total_sales) AS BIGINT) AS daily_sales FROM by_category
GROUP BY summary_date ORDER BY summary_date DESC LIMIT 30""",
    "top_products": f"""
WITH {d.CLEANED_SQL}, {PERFORMANCE_SQL}
SELECT product_name, total_sales, avg_rating FROM performance
ORDER BY total_sales DESC, product_id, product_name, category LIMIT 10""",
    "job_cost_report": """
WITH job_log AS (
  SELECT 'u' || user_id AS user_email, event_type AS query, CAST(floor(value * 1e9) AS BIGINT) AS processed,
         CAST(floor(value * 1.1e9) AS BIGINT) AS billed, ts
  FROM events WHERE ts >= TIMESTAMP '2024-01-23'
)
SELECT user_email, query, processed / 1e9 AS gb_processed, billed / 1e9 * 5 / 1000 AS estimated_cost_usd
FROM job_log ORDER BY billed DESC, user_email, query, processed LIMIT 10""",
    "dash_category": f"""
WITH {d.CLEANED_SQL}, {_BY_CATEGORY_SQL}
SELECT category, CAST(sum(total_sales) AS BIGINT) AS total_sales FROM by_category GROUP BY category""",
    "dash_trend": f"""
WITH {d.CLEANED_SQL}, {_BY_CATEGORY_SQL}
SELECT summary_date, CAST(sum(total_sales) AS BIGINT) AS total_sales FROM by_category GROUP BY summary_date""",
    "dash_price": f"""
WITH {d.CLEANED_SQL}, {_BY_CATEGORY_SQL}
SELECT category, {sql_avg("avg_price", 8)} AS avg_price FROM by_category GROUP BY category""",
    "dash_products": f"""
WITH {d.CLEANED_SQL}, {PERFORMANCE_SQL}
SELECT product_name, category, total_sales, avg_rating FROM performance""",
    "table_counts": f"""
WITH {d.CLEANED_SQL}, {_BY_CATEGORY_SQL}
SELECT 'raw_sales_data' AS table_name, count(*) AS "rows" FROM snapshots
UNION ALL SELECT 'cleaned_sales_data', count(*) FROM cleaned
UNION ALL SELECT 'daily_summary', count(*) FROM by_category""",
    "freshness": f"WITH {d.CLEANED_SQL} SELECT max(sale_date) AS latest FROM cleaned",
    "check_negative_prices": f"""
WITH {d.SNAPSHOTS_SQL}, {_RULE_COUNTS}
SELECT check_name, bad_rows, bad_rows = 0 AS passed FROM broken WHERE check_name = 'negative_prices'""",
    "check_null_ids": f"""
WITH {d.SNAPSHOTS_SQL}, {_RULE_COUNTS}
SELECT check_name, bad_rows, bad_rows = 0 AS passed FROM broken WHERE check_name = 'null_product_ids'""",
    "quality_score": f"""
WITH {d.SNAPSHOTS_SQL}, {_RULE_COUNTS},
scored AS (SELECT count(*) FILTER (WHERE bad_rows = 0) AS passed, count(*) AS total FROM broken)
SELECT passed, total, CAST(passed * 100 // total AS BIGINT) AS percent,
       CASE WHEN passed * 100 // total = 100 THEN 'all' WHEN passed * 100 // total >= 80 THEN 'most'
            ELSE 'attention' END AS band
FROM scored""",
    "raw_duplicates": f"""
WITH {d.SNAPSHOTS_SQL} SELECT count(*) AS duplicate_count FROM {_GROUPS} WHERE copies > 1""",
    "raw_nulls": f"""
WITH {d.SNAPSHOTS_SQL}
SELECT count(*) FILTER (WHERE product_id IS NULL) AS null_product_id,
       count(*) FILTER (WHERE price IS NULL) AS null_price,
       count(*) FILTER (WHERE category IS NULL) AS null_category,
       count(*) FILTER (WHERE product_id IS NULL) + count(*) FILTER (WHERE price IS NULL)
         + count(*) FILTER (WHERE category IS NULL) AS total_nulls
FROM snapshots""",
    "quality_report": f"""
WITH {d.SNAPSHOTS_SQL},
found AS (
  SELECT 'duplicates' AS metric, count(*) AS bad_rows FROM {_GROUPS} WHERE copies > 1
  UNION ALL
  SELECT 'nulls', count(*) FILTER (WHERE product_id IS NULL) + count(*) FILTER (WHERE price IS NULL)
                  + count(*) FILTER (WHERE category IS NULL) FROM snapshots
)
SELECT metric, bad_rows, CASE WHEN bad_rows > 0 THEN 'warning' ELSE 'ok' END AS status FROM found""",
    "sales_lags": f"WITH {d.CLEANED_SQL}, {_DAYS_SQL} SELECT *, {_lag(1)}, {_lag(7)}, {_lag(30)} FROM days",
    "moving_averages": f"WITH {d.CLEANED_SQL}, {_DAYS_SQL} SELECT *, {_mean(7)}, {_mean(30)} FROM days",
    "incremental_features": f"WITH {d.CLEANED_SQL}, {FEATURES_SQL} SELECT * FROM features",
    "ml_features": f"WITH {d.CLEANED_SQL}, {FEATURES_SQL} SELECT * FROM features",
    "calendar_features": f"""
WITH {d.CLEANED_SQL}
SELECT {_PRODUCT_DAY}, {_WEEKDAY}, {_WEEKEND}
FROM cleaned GROUP BY product_id, product_name, category, sale_date""",
    "seq_split": f"""
WITH {d.CLEANED_SQL}, {FEATURES_SQL},
per_day AS (SELECT sale_date, count(*) AS n FROM features GROUP BY sale_date),
flags AS (
  SELECT sale_date, sum(n) OVER (ORDER BY sale_date) > sum(n) OVER () * (1 - 0.2) AS is_eval FROM per_day
)
SELECT product_id, product_name, category, sale_date, daily_sales, is_eval FROM features JOIN flags USING (sale_date)""",
    "cluster_features": f"""
WITH {d.CLEANED_SQL}
SELECT product_id, product_name, category, {sql_avg("price")} AS avg_price,
       CAST(sum(sales_count) AS DOUBLE) / count(*) AS avg_sales, {sql_avg("rating")} AS avg_rating,
       {sql_avg("discount_percent")} AS avg_discount, count(*) AS frequency
FROM cleaned
WHERE sale_date BETWEEN CAST(DATE '2001-08-01' - INTERVAL 3 MONTH AS DATE) AND DATE '2001-08-01'
GROUP BY product_id, product_name, category""",
    "price_zscore": f"""
WITH {d.CLEANED_SQL},
sums AS (
  SELECT category, count(price) AS n, {sql_sum("price")} AS total,
         CAST(sum(CAST(price AS DECIMAL(14,2)) * CAST(price AS DECIMAL(14,2))) AS DOUBLE) AS squares
  FROM cleaned GROUP BY category
),
moments AS (
  SELECT category, total / n AS mean, sqrt((squares - total * (total / n)) / nullif(n - 1, 0)) AS deviation FROM sums
),
scored AS (
  SELECT category, product_id, sale_date, price, (price - mean) / nullif(deviation, 0) AS z_score
  FROM cleaned JOIN moments USING (category)
)
SELECT * FROM scored WHERE abs(z_score) > {Z_LIMIT}""",
}
