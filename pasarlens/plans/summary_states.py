"""The daily summary from states that can be merged: a batch adds its own states, and no day is ever computed again from its rows.

A state holds, for a day and a batch, counts and exact sums, the candidate for the largest transaction, and the set of sellers as
bitmaps over the numbers that a dictionary gives them. Counts and sums are added, candidates compared and bitmaps united, so
that the merged states give what the rows would, distinct sellers included. A state is as large as a day needs, not as its rows are.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.functions import as_exact
from pasarlens.operators.ranks import numbered
from pasarlens.streaming.ingest import run_available

LARGEST = "struct<unknown: boolean, negative: double, transaction_id: string, product_id: string, category: string, product_name: string>"
STATES = (
    f"sale_date date, transactions bigint, revenue decimal(38,6), priced bigint, quantity bigint, largest {LARGEST}, batch_id bigint"
)
SELLERS = "sale_date date, bucket bigint, sellers binary, batch_id bigint"
DICTIONARY = "seller_name string, number bigint, batch_id bigint"


def _read(spark: SparkSession, path: str, schema: str, before: int) -> DataFrame:
    """The rows that batches before this one have written."""
    folders = [f"{path}/batch_id={b}" for b in range(before)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def extend_dictionary(names: DataFrame, known: DataFrame) -> DataFrame:
    """Numbers for the names that have none: they follow the largest number given, in the order of the names."""
    fresh = names.where("seller_name IS NOT NULL").distinct().join(known.select("seller_name"), "seller_name", "left_anti")
    first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    ranked = numbered(fresh, [F.col("seller_name")], "number")
    return ranked.select("seller_name", (F.col("number") + first).alias("number"))


def day_states(sales: DataFrame) -> DataFrame:
    """Counts, sums and the largest transaction of each day of a batch."""
    amount = F.col("total_amount").cast("double")
    largest = F.struct(
        amount.isNull().alias("unknown"), (-amount).alias("negative"), "transaction_id", "product_id", "category", "product_name"
    )
    return sales.groupBy("sale_date").agg(
        F.count("transaction_id").alias("transactions"),
        F.sum(as_exact("total_amount")).cast("decimal(38,6)").alias("revenue"),
        F.count(as_exact("total_amount")).alias("priced"),
        F.sum("quantity").cast("bigint").alias("quantity"),
        F.min(largest).cast(LARGEST).alias("largest"),
    )


def seller_states(sales: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The sellers of each day of a batch as bitmaps of their numbers, one for each range of numbers."""
    pairs = sales.select("sale_date", "seller_name").distinct().join(dictionary, "seller_name")
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return pairs.groupBy("sale_date", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("sellers"))


def merge_day_states(states: DataFrame) -> DataFrame:
    return states.groupBy("sale_date").agg(
        F.sum("transactions").alias("transactions"), F.sum("revenue").alias("revenue"), F.sum("priced").alias("priced"),
        F.sum("quantity").alias("quantity"), F.min("largest").alias("largest"),
    )


def merge_seller_states(states: DataFrame) -> DataFrame:
    return states.groupBy("sale_date", "bucket").agg(F.bitmap_or_agg("sellers").alias("sellers"))


def summary_of_states(days: DataFrame, sellers: DataFrame, created_at: datetime) -> DataFrame:
    """The daily summary of any states, merged."""
    merged = merge_day_states(days)
    counted = merge_seller_states(sellers).groupBy(F.col("sale_date").alias("_day")).agg(
        F.sum(F.bitmap_count("sellers")).alias("unique_sellers")
    )
    revenue = F.col("revenue").cast("double")
    return merged.join(counted, merged["sale_date"].eqNullSafe(counted["_day"]), "left").select(
        F.col("sale_date").alias("summary_date"),
        F.col("transactions").alias("total_transactions"),
        revenue.alias("total_revenue"),
        F.col("quantity").alias("total_quantity"),
        F.round(F.try_divide(revenue, F.col("priced")), 0).alias("avg_order_value"),
        F.col("largest.category").alias("top_category"),
        F.col("largest.product_name").alias("top_product"),
        F.coalesce("unique_sellers", F.lit(0)).alias("unique_sellers"),
        F.lit(created_at).cast("timestamp_ntz").alias("created_at"),
    )


def stream_states(batches: DataFrame, root: str, checkpoint: str) -> None:
    """Add the states of each micro-batch of sales. Of earlier batches only the sellers' numbers are read; a replayed batch replaces its
    own folders and gives new sellers the same numbers again."""
    spark = batches.sparkSession

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            known = _read(spark, f"{root}/sellers", DICTIONARY, batch_id).select("seller_name", "number")
            fresh = extend_dictionary(batch.select("seller_name"), known)
            fresh.write.mode("overwrite").parquet(f"{root}/sellers/batch_id={batch_id}")
            numbers = _read(spark, f"{root}/sellers", DICTIONARY, batch_id + 1).select("seller_name", "number")
            day_states(batch).write.mode("overwrite").parquet(f"{root}/days/batch_id={batch_id}")
            seller_states(batch, numbers).write.mode("overwrite").parquet(f"{root}/day_sellers/batch_id={batch_id}")
        finally:
            batch.unpersist()

    run_available(batches, checkpoint, one_batch)


def stored_summary(spark: SparkSession, root: str, created_at: datetime) -> DataFrame:
    """The summary of everything that has arrived."""
    days = spark.read.schema(STATES).parquet(f"{root}/days")
    return summary_of_states(days, spark.read.schema(SELLERS).parquet(f"{root}/day_sellers"), created_at)
