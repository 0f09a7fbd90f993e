"""The given tables seen as sales, snapshots, reviews, job log and executions, in Spark and in SQL.

Both forms use the same expressions. No join carries a hint but that of the sellers, which are counted first: the size-checked
broadcast threshold decides, and skewed keys of a shuffled join are split at run time.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.functions import month_text, weekday_name
from pasarlens.operators.cleaning import clean_sales

AS_OF = date(2001, 8, 1)  # sales and snapshots
EVENTS_AS_OF = date(2024, 1, 30)  # reviews, job log and executions
CREATED_AT = datetime(2001, 8, 1, 3, 0, 0)
HISTORY_UNTIL = date(2000, 1, 1)  # rows before this day play the stored table in load and merge queries


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


#: Suppliers up to which sellers are broadcast, so that the sales, by then as wide as they get, need no shuffle for them.
FEW_SUPPLIERS = 1 << 20


def _sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    sellers = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return F.broadcast(sellers) if supplier.count() <= FEW_SUPPLIERS else sellers


def with_sale_calendar(rows: DataFrame) -> DataFrame:
    """Month and weekday after the day they follow from."""
    place = rows.columns.index("sale_date") + 1
    added = [month_text("sale_date").alias("sale_month"), weekday_name("sale_date").alias("day_of_week")]
    return rows.select(*rows.columns[:place], *added, *rows.columns[place:])


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sale_calendar(sales_rows(spark, sf_dir))


def sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without month and weekday."""
    lineitem, part, sellers = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), _sellers(spark, sf_dir)
    joined = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        sellers, F.col("l_suppkey") == F.col("s_suppkey")
    )
    day = F.to_date("l_shipdate")
    return joined.select(
        F.concat(_key("TRX", "l_orderkey"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        _key("PROD", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.round(F.col("l_discount") * 100, 0).alias("discount_percent"),
        (F.col("p_retailprice") * (1 - F.col("l_discount"))).alias("actual_price"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("s_name").alias("seller_name"),
        F.col("n_name").alias("seller_location"),
        day.alias("sale_date"),
        day.alias("ingestion_date"),
    )


SALES_SQL = """
sales AS (
  SELECT 'TRX' || l_orderkey || '-' || l_linenumber AS transaction_id,
         'PROD' || p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_retailprice AS price, round(l_discount * 100, 0) AS discount_percent,
         p_retailprice * (1 - l_discount) AS actual_price,
         CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS total_amount,
         s_name AS seller_name, n_name AS seller_location,
         CAST(l_shipdate AS DATE) AS sale_date,
         strftime(l_shipdate, '%Y-%m') AS sale_month, dayname(l_shipdate) AS day_of_week,
         CAST(l_shipdate AS DATE) AS ingestion_date
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
)"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product snapshots, with some missing ids and missing or negative prices on purpose."""
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    amount = F.col("l_extendedprice").cast("decimal(14,2)")
    price = (amount * 3).cast("double")
    defect = F.col("l_orderkey") % 50 == 0
    line, size = F.col("l_linenumber"), F.col("p_size")
    return joined.select(
        F.when(~(defect & (line == 5)), _key("PROD", "l_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lower("p_type").alias("category"),
        F.when(defect & (line == 7), None).when(defect & (line == 6), -price).otherwise(price).alias("price"),
        F.round(amount * F.lit(3.3).cast("decimal(2,1)"), 2).cast("double").alias("original_price"),
        F.round(F.col("l_discount") * 500, 0).alias("discount_percent"),
        F.col("l_quantity").cast("bigint").alias("sales_count"),
        (3 + (size % 21) / 10.0).cast("double").alias("rating"),
        (size * 7).cast("bigint").alias("review_count"),
        (F.col("l_orderkey") % 40).alias("stock"),
        _key("Seller ", "l_suppkey").alias("seller_name"),
        F.concat(F.lit("Zone "), (F.col("l_suppkey") % 25).cast("string")).alias("seller_location"),
        F.col("l_shipdate").alias("timestamp"),
        F.to_date("l_shipdate").alias("ingestion_date"),
    )


SNAPSHOTS_SQL = """
snapshots AS (
  SELECT CASE WHEN l_linenumber = 5 AND l_orderkey % 50 = 0 THEN NULL ELSE 'PROD' || l_partkey END AS product_id,
         p_name AS product_name, lower(p_type) AS category,
         CASE WHEN l_linenumber = 7 AND l_orderkey % 50 = 0 THEN NULL
              WHEN l_linenumber = 6 AND l_orderkey % 50 = 0
                   THEN -CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * 3 AS DOUBLE)
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * 3 AS DOUBLE) END AS price,
         CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(3.3 AS DECIMAL(2,1)), 2) AS DOUBLE)
              AS original_price,
         round(l_discount * 500, 0) AS discount_percent,
         CAST(l_quantity AS BIGINT) AS sales_count,
         CAST(3 + (p_size % 21) / 10.0 AS DOUBLE) AS rating,
         CAST(p_size * 7 AS BIGINT) AS review_count,
         l_orderkey % 40 AS stock,
         'Seller ' || l_suppkey AS seller_name, 'Zone ' || (l_suppkey % 25) AS seller_location,
         l_shipdate AS "timestamp", CAST(l_shipdate AS DATE) AS ingestion_date
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


def odd_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshots of lines 1 to 4 with prices that are not finite, or very large, in one order of fifty."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("amount"), _key("PROD", "l_partkey").alias("product_id"),
        (F.col("l_orderkey") % 50 == 1).alias("odd"), F.col("l_shipdate").alias("timestamp"), F.round(F.col("l_discount") * 500, 0).alias("discount_percent"),
    )
    price = F.col("amount").cast("decimal(14,2)").cast("double")
    for line, value in ((1, float("nan")), (2, float("inf")), (3, float("-inf")), (4, 2e13)):
        price = F.when(F.col("odd") & (F.col("line") == line), F.lit(value)).otherwise(price)
    texts = {c: F.concat(F.lit(f"{c} "), F.col("line").cast("string")) for c in ("product_name", "category", "seller_name", "seller_location")}
    numbers = {c: F.lit(1).cast("bigint") for c in ("sales_count", "review_count", "stock")}
    return lines.where("line <= 4").withColumns({"price": price, "rating": F.lit(4.0), **texts, **numbers})


ODD_SNAPSHOTS_SQL = """
odd_snapshots AS (
  SELECT 'PROD' || l_partkey AS product_id, 'CATEGORY ' || l_linenumber AS category, l_shipdate AS "timestamp",
         CASE WHEN l_orderkey % 50 <> 1 OR l_linenumber > 4 THEN CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS DOUBLE)
              ELSE CAST(['nan', 'inf', '-inf', '2e13'][l_linenumber] AS DOUBLE) END AS price,
         round(l_discount * 500, 0) AS discount_percent
  FROM lineitem WHERE l_linenumber <= 4
)"""


def cleaned(spark: SparkSession, sf_dir: str, gather: tuple[str, ...] = ()) -> DataFrame:
    return clean_sales(snapshots(spark, sf_dir), gather=gather)


CLEANED_SQL = (
    SNAPSHOTS_SQL
    + """,
cleaned AS (
  SELECT DISTINCT product_id, trim(product_name) AS product_name, upper(trim(category)) AS category, price,
         CAST(round(CAST(price AS DECIMAL(20,6)) * (100 - CAST(coalesce(discount_percent, 0) AS DECIMAL(9,6)))
                    * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE) AS discount_price,
         discount_percent, coalesce(sales_count, 0) AS sales_count, rating,
         coalesce(review_count, 0) AS review_count,
         CASE WHEN stock = 0 THEN 'OUT_OF_STOCK' WHEN stock < 10 THEN 'LOW_STOCK' ELSE 'IN_STOCK' END
              AS stock_status,
         seller_name, seller_location,
         CAST("timestamp" AS DATE) AS sale_date, "timestamp" AS sale_timestamp
  FROM snapshots WHERE price > 0 AND product_id IS NOT NULL
)"""
)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = F.get_json_object("props", "$.k").cast("bigint")
    joined = table(spark, sf_dir, "events").join(table(spark, sf_dir, "part"), product == F.col("p_partkey"))
    kind = F.col("event_type")
    sentiment = F.when(kind.isin("purchase", "signup"), "Positive").when(kind == "error", "Negative")
    return joined.select(
        _key("R", "event_id").alias("review_id"),
        kind.alias("review_text"),
        F.to_date("ts").alias("review_date"),
        _key("PROD", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("p_retailprice").alias("product_price"),
        (1 + F.col("event_id") % 5).alias("rating"),
        F.col("p_size").cast("bigint").alias("sold_count"),
        _key("S", "user_id").alias("shop_id"),
        sentiment.otherwise("Neutral").alias("sentiment_label"),
    )


REVIEWS_SQL = """
reviews AS (
  SELECT 'R' || event_id AS review_id, event_type AS review_text, CAST(ts AS DATE) AS review_date,
         'PROD' || p_partkey AS product_id, p_name AS product_name, p_type AS product_category,
         p_retailprice AS product_price, CAST(1 + event_id % 5 AS BIGINT) AS rating,
         CAST(p_size AS BIGINT) AS sold_count, 'S' || user_id AS shop_id,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'Positive'
              WHEN event_type = 'error' THEN 'Negative' ELSE 'Neutral' END AS sentiment_label
  FROM events JOIN part ON CAST(json_extract_string(props, '$.k') AS BIGINT) = p_partkey
)"""


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue row per part."""
    size = F.col("p_size")
    price = F.col("p_retailprice").cast("decimal(14,2)")
    return table(spark, sf_dir, "part").select(
        _key("PROD", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.round(price * F.lit(1.1).cast("decimal(2,1)"), 2).cast("double").alias("original_price"),
        (size * 3).cast("bigint").alias("stock"),
        F.col("p_brand").alias("seller_name"),
        F.concat(F.lit("Zone "), (size % 25).cast("string")).alias("seller_location"),
        (3 + (size % 21) / 10.0).cast("double").alias("rating"),
        (size * 7).cast("bigint").alias("review_count"),
    )


CATALOGUE_SQL = """
catalogue AS (
  SELECT 'PROD' || p_partkey AS product_id, p_name AS product_name, p_type AS category, p_retailprice AS price,
         CAST(round(CAST(p_retailprice AS DECIMAL(14,2)) * CAST(1.1 AS DECIMAL(2,1)), 2) AS DOUBLE)
              AS original_price,
         CAST(p_size * 3 AS BIGINT) AS stock, p_brand AS seller_name, 'Zone ' || (p_size % 25) AS seller_location,
         CAST(3 + (p_size % 21) / 10.0 AS DOUBLE) AS rating, CAST(p_size * 7 AS BIGINT) AS review_count
  FROM part
)"""


def bare_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions that only know their product's id."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(_key("TRX", "l_orderkey"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        _key("PROD", "l_partkey").alias("product_id"),
        F.round(F.col("l_discount") * 100, 0).alias("discount_percent"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.to_date("l_shipdate").alias("sale_date"),
    )


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        _key("u", "user_id").alias("user_email"),
        F.col("event_type").alias("query"),
        F.floor(F.col("value") * 1e9).alias("total_bytes_processed"),
        F.floor(F.col("value") * 1.1e9).alias("total_bytes_billed"),
        F.col("ts").alias("creation_time"),
    )


def executions(events: DataFrame) -> DataFrame:
    """Function runs with status and cost; works on a batch and on a stream of events. A watermark needs a
    TIMESTAMP, so the zone-less event time is read in the session time zone, UTC."""
    status = F.when(F.col("event_type") == "error", "error").otherwise("ok")
    return events.select(F.col("ts").cast("timestamp").alias("ts"), status.alias("status"), F.col("value").alias("cost"))


def history(df: DataFrame, day: str = "sale_date") -> DataFrame:
    """The part of a table that plays the already stored rows."""
    return df.where(F.col(day) < F.lit(HISTORY_UNTIL))


def arriving(df: DataFrame, day: str = "sale_date") -> DataFrame:
    """The part that plays the new batch."""
    return df.where(F.col(day) >= F.lit(HISTORY_UNTIL))


# Exact sums and means in SQL, as in pasarlens.functions.money.
def sql_sum(column: str, scale: int = 6) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL({22 + scale},{scale}))) AS DOUBLE)"


def sql_avg(column: str, scale: int = 6) -> str:
    return f"{sql_sum(column, scale)} / nullif(count({column}), 0)"

