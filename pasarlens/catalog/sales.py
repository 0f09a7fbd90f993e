"""Sales-transaction reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasarlens.catalog import datasets as d
from pasarlens.catalog.datasets import AS_OF, CREATED_AT, sql_avg, sql_sum
from pasarlens.operators.cleaning import derive_transactions, enrich_sales
from pasarlens.plans import sales_reports as r
from pasarlens.plans.snapshot_reports import window_totals

WINDOWS = {
    "days_7": {"days": 7},
    "days_30": {"days": 30},
    "weeks_8": {"weeks": 8},
    "months_3": {"months": 3},
    "months_6": {"months": 6},
}


def _summary(spark, sf_dir):
    return r.daily_summary(d.sales(spark, sf_dir), CREATED_AT)


QUERIES = {
    "category_sales": lambda spark, sf: r.category_sales(d.sales(spark, sf)),
    "top_sellers": lambda spark, sf: r.top_sellers(d.sales(spark, sf)),
    "daily_sales_trends": lambda spark, sf: r.daily_sales_trends(d.sales(spark, sf)),
    "daily_summary": _summary,
    "summary_preview": lambda spark, sf: r.summary_preview(_summary(spark, sf)),
    "summary_sample": lambda spark, sf: r.summary_sample(_summary(spark, sf)),
    "summary_sample_size": lambda spark, sf: r.summary_sample(_summary(spark, sf)).agg(F.count("*").alias("rows")),
    "category_revenue": lambda spark, sf: r.category_revenue(d.sales(spark, sf)),
    "transaction_profile": lambda spark, sf: r.transaction_profile(d.sales(spark, sf)),
    "derive_transactions": lambda spark, sf: derive_transactions(
        d.sales(spark, sf).select(
            "transaction_id", "product_id", "price", "discount_percent", "quantity", "sale_date"
        )
    ),
    "enrich_sales": lambda spark, sf: enrich_sales(d.bare_transactions(spark, sf), d.catalogue(spark, sf)),
    "recent_window": lambda spark, sf: window_totals(d.sales(spark, sf), AS_OF, WINDOWS),
}

SUMMARY_SQL = f"""
WITH {d.SALES_SQL},
largest AS (
  SELECT sale_date, category AS top_category, product_name AS top_product,
         row_number() OVER (PARTITION BY sale_date ORDER BY total_amount DESC NULLS LAST, transaction_id,
                            product_id, category, product_name) AS place
  FROM sales
),
measures AS (
  SELECT sale_date, count(transaction_id) AS total_transactions, {sql_sum("total_amount")} AS total_revenue,
         CAST(sum(quantity) AS BIGINT) AS total_quantity, round({sql_avg("total_amount")}, 0) AS avg_order_value,
         count(DISTINCT seller_name) AS unique_sellers
  FROM sales GROUP BY sale_date
)
SELECT m.sale_date AS summary_date, total_transactions, total_revenue, total_quantity, avg_order_value,
       top_category, top_product, unique_sellers, TIMESTAMP '2001-08-01 03:00:00' AS created_at
FROM measures m JOIN largest l ON m.sale_date = l.sale_date AND l.place = 1
"""

_NET = "price * (1 - discount_percent / 100)"


def _window_sql(name: str, since: str) -> str:
    return (
        f"SELECT '{name}' AS \"window\", count(*) AS \"rows\", {sql_sum('total_amount')} AS revenue FROM sales "
        f"WHERE sale_date BETWEEN CAST(DATE '2001-08-01' - INTERVAL {since} AS DATE) AND DATE '2001-08-01'"
    )


ORACLE = {
    "summary_sample_size": f"""
WITH {d.SALES_SQL}
SELECT least(100, count(DISTINCT sale_date)) AS "rows" FROM sales""",
    "category_sales": f"""
WITH {d.SALES_SQL}
SELECT category, count(transaction_id) AS total_transactions, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       {sql_sum("total_amount")} AS total_revenue, round({sql_avg("actual_price")}, 0) AS avg_price,
       count(DISTINCT seller_name) AS unique_sellers
FROM sales GROUP BY category""",
    "top_sellers": f"""
WITH {d.SALES_SQL}
SELECT seller_name, seller_location, count(transaction_id) AS total_transactions,
       {sql_sum("total_amount")} AS total_revenue, count(DISTINCT category) AS categories_sold
FROM sales GROUP BY seller_name, seller_location
ORDER BY total_revenue DESC, seller_name, seller_location LIMIT 100""",
    "daily_sales_trends": f"""
WITH {d.SALES_SQL}
SELECT sale_date, count(transaction_id) AS transactions, {sql_sum("total_amount")} AS revenue,
       round({sql_avg("total_amount")}, 0) AS avg_order_value
FROM sales GROUP BY sale_date""",
    "daily_summary": SUMMARY_SQL,
    "summary_sample": SUMMARY_SQL + "ORDER BY md5(CAST(summary_date AS VARCHAR)) LIMIT 100",
    "summary_preview": SUMMARY_SQL + "ORDER BY summary_date DESC LIMIT 10",
    "category_revenue": f"""
WITH {d.SALES_SQL}
SELECT category, count(*) AS transactions, {sql_sum("total_amount")} AS revenue FROM sales GROUP BY category""",
    "transaction_profile": f"""
WITH {d.SALES_SQL}
SELECT count(DISTINCT product_id) AS total_products, count(*) AS total_transactions,
       count(DISTINCT category) AS categories, {sql_sum("total_amount")} AS total_revenue
FROM sales""",
    "derive_transactions": f"""
WITH {d.SALES_SQL}
SELECT transaction_id, product_id, price, discount_percent, quantity, sale_date,
       CAST(trunc({_NET}) AS BIGINT) AS actual_price, CAST(trunc({_NET} * quantity) AS BIGINT) AS total_amount,
       strftime(sale_date, '%Y-%m') AS sale_month, dayname(sale_date) AS day_of_week
FROM sales""",
    "enrich_sales": f"""
WITH {d.CATALOGUE_SQL},
bare AS (
  SELECT 'TRX' || l_orderkey || '-' || l_linenumber AS transaction_id, 'PROD' || l_partkey AS product_id,
         round(l_discount * 100, 0) AS discount_percent, CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_shipdate AS DATE) AS sale_date
  FROM lineitem
)
SELECT product_id, transaction_id, discount_percent, quantity, sale_date, product_name, category, price,
       seller_name, seller_location, CAST(trunc({_NET}) AS BIGINT) AS actual_price,
       CAST(trunc({_NET} * quantity) AS BIGINT) AS total_amount,
       strftime(sale_date, '%Y-%m') AS sale_month, dayname(sale_date) AS day_of_week
FROM bare JOIN catalogue USING (product_id)""",
    "recent_window": f"WITH {d.SALES_SQL}\n"
    + "\nUNION ALL\n".join(
        _window_sql(name, since)
        for name, since in [
            ("days_7", "7 DAY"),
            ("days_30", "30 DAY"),
            ("weeks_8", "56 DAY"),
            ("months_3", "3 MONTH"),
            ("months_6", "6 MONTH"),
        ]
    ),
}
