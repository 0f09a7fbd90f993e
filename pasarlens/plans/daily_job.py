"""The daily batch run and the report refresh, from stored tables to stored tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pasarlens.operators.cleaning import clean_sales, rebuild_sale_days
from pasarlens.operators.quality import quality_report
from pasarlens.plans.review_reports import sentiment_summary
from pasarlens.plans.sales_reports import daily_summary
from pasarlens.plans.snapshot_reports import daily_category_summary, product_performance, summary_stats
from pasarlens.schemas import CLEANED, SNAPSHOTS
from pasarlens.sources.landing import load_ndjson
from pasarlens.sources.tables import (
    append_table,
    archive_files,
    conform,
    replace_partitions,
    replace_table,
    stamp_ingestion,
    waiting_files,
)

CLUSTER = ("category", "product_id")


def raw_table(spark: SparkSession, warehouse: str, schema: T.StructType) -> DataFrame:
    """The raw records, stored by ingestion day. A declared column that old files lack is null there."""
    return conform(spark.read.schema(schema).parquet(f"{warehouse}/raw_sales_data"), SNAPSHOTS)


def run_day(
    spark: SparkSession,
    landed: str,
    warehouse: str,
    staging: str,
    schema: T.StructType,
    as_of: date,
    day: date | None = None,
    partition: str | None = "sale_date",
    rerun: bool = False,
) -> dict[str, object]:
    """Load landed records, check them, clean them and rebuild the summary tables.

    Steps meet in stored tables, so each can be rerun alone and a lost step never recomputes the earlier ones. Without
    waiting files nothing is done; loaded files are moved to the archive, so a second run adds nothing. ``day`` restricts
    cleaning to one ingestion day; without it everything that was landed is cleaned. ``rerun`` repeats a day: nothing is
    loaded, and the sale days it touches are replaced where a first run appends. Quality findings are stored before
    cleaning and never stop the run. Returns the number of loaded rows, and ``quality`` and ``stats`` if there were any.
    """
    raw_path, cleaned_path = f"{warehouse}/raw_sales_data", f"{warehouse}/cleaned_sales_data"
    loaded = 0
    if rerun and (day is None or partition != "sale_date"):
        raise ValueError("a rerun needs a day and a table stored by sale_date")
    if not rerun:
        files = waiting_files(spark, landed)
        if not files:
            return {"loaded": 0}
        loaded = load_ndjson(
            spark, landed, raw_path, staging, schema, partition="ingestion_date", cluster=CLUSTER
        )["loaded"]
        archive_files(spark, files, f"{warehouse}/archive/{as_of.isoformat()}/{datetime.now():%H%M%S%f}")
    raw = raw_table(spark, warehouse, schema)
    quality = stamp_ingestion(quality_report(raw, day), as_of)
    replace_partitions(quality, f"{warehouse}/quality_report", "ingestion_date")
    if rerun:
        replace_partitions(conform(rebuild_sale_days(raw, day), CLEANED), cleaned_path, partition, CLUSTER)
    else:
        append_table(conform(clean_sales(raw, day), CLEANED), cleaned_path, partition, CLUSTER)
    cleaned = spark.read.schema(CLEANED).parquet(cleaned_path)
    replace_table(daily_category_summary(cleaned, as_of), f"{warehouse}/daily_summary")
    replace_table(product_performance(cleaned, as_of), f"{warehouse}/product_performance")
    return {
        "loaded": loaded,
        "quality": spark.read.parquet(f"{warehouse}/quality_report").where(f"ingestion_date = date'{as_of}'").drop("ingestion_date"),
        "stats": summary_stats(cleaned, as_of),
    }


def refresh_reports(sales: DataFrame, reviews: DataFrame, warehouse: str, created_at: datetime) -> None:
    """Replace the stored daily sales summary and the stored sentiment summary."""
    replace_table(daily_summary(sales, created_at), f"{warehouse}/sales_daily_summary")
    replace_table(sentiment_summary(reviews, created_at), f"{warehouse}/sentiment_summary")
