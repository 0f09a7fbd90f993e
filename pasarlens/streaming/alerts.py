"""Execution metrics per time bucket and the alerts evaluated on them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pasarlens.streaming.ingest import run_available

BUCKET_METRICS = T.StructType(
    [
        T.StructField("bucket_start", T.TimestampNTZType()),
        T.StructField("bucket_end", T.TimestampNTZType()),
        T.StructField("executions", T.LongType()),
        T.StructField("errors", T.LongType()),
        T.StructField("cost", T.DoubleType()),
    ]
)


#: Bucket counts of one micro-batch, before they are added up; the cost stays a decimal so that the sum is exact.
PARTIAL_METRICS = T.StructType(
    [
        *BUCKET_METRICS.fields[:4],
        T.StructField("cost", T.DecimalType(38, 6)),
        T.StructField("late", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


_NEWEST = "newest timestamp_ntz"


def _partial_metrics(executions: DataFrame, seconds: int, newest: datetime | None = None, grace: int = 600) -> DataFrame:
    """Counts per bucket. ``late`` rows are those more than ``grace`` seconds older than the ``newest`` seen before."""
    late = F.lit(False) if newest is None else F.col("ts") < F.lit(newest - timedelta(seconds=grace))
    counted = executions.groupBy(F.window("ts", f"{seconds} seconds").alias("bucket")).agg(
        F.count("*").alias("executions"),
        F.count_if(F.col("status") != "ok").alias("errors"),
        F.sum(F.col("cost").cast("decimal(28,6)")).alias("cost"),
        F.count_if(late).alias("late"),
    )
    return counted.select(
        F.col("bucket.start").cast("timestamp_ntz").alias("bucket_start"),
        F.col("bucket.end").cast("timestamp_ntz").alias("bucket_end"),
        "executions",
        "errors",
        "cost",
        "late",
    )


def _added_up(partial: DataFrame) -> DataFrame:
    return partial.groupBy("bucket_start", "bucket_end").agg(
        F.sum("executions").alias("executions"),
        F.sum("errors").alias("errors"),
        F.sum("cost").cast("double").alias("cost"),
    )


def bucket_metrics(executions: DataFrame, seconds: int) -> DataFrame:
    """Executions, errors and cost per bucket of a batch."""
    return _added_up(_partial_metrics(executions, seconds))


def stream_bucket_metrics(executions: DataFrame, table: str, checkpoint: str, seconds: int) -> DataFrame:
    """Store each micro-batch's counts per bucket and return the buckets, open ones included.

    A micro-batch is reduced to one row per bucket; buckets are the sums over batches. So a bucket is up to date after every
    batch, a late row still counts, and nothing is held in state. How many rows came late is in ``late_rows``.
    """
    spark = executions.sparkSession

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        newest = None
        if batch_id > 0:
            # one row beside the table, however many batches it has
            newest = spark.read.schema(_NEWEST).parquet(f"{table}_newest/batch_id={batch_id - 1}").first()[0]
        counts = _partial_metrics(batch, seconds, newest)
        own = f"{table}/batch_id={batch_id}"
        counts.write.mode("overwrite").parquet(own)
        ends = [newest, spark.read.schema(PARTIAL_METRICS).parquet(own).agg(F.max("bucket_end")).first()[0]]
        ends = [t for t in ends if t is not None]
        row = spark.createDataFrame([(max(ends, default=None),)], _NEWEST)
        row.coalesce(1).write.mode("overwrite").parquet(f"{table}_newest/batch_id={batch_id}")

    run_available(executions, checkpoint, one_batch)
    return read_bucket_metrics(spark, table)


def read_bucket_metrics(spark: SparkSession, table: str) -> DataFrame:
    return _added_up(spark.read.schema(PARTIAL_METRICS).parquet(table))


def late_rows(spark: SparkSession, table: str) -> DataFrame:
    """One row: how many rows have arrived, and how many of them late."""
    stored = spark.read.schema(PARTIAL_METRICS).parquet(table)
    return stored.agg(F.coalesce(F.sum("executions"), F.lit(0)).alias("rows"), F.coalesce(F.sum("late"), F.lit(0)).alias("late"))


def error_alerts(metrics: DataFrame, seconds: int, threshold: int = 5, held: int = 5) -> DataFrame:
    """Bucket ends at which the error count has been above the threshold for ``held`` buckets in a row.

    A quiet bucket has no row and breaks the run, as zero errors would. Each breaching bucket is counted towards
    itself and the next ``held - 1`` buckets; a bucket that collects all ``held`` is an alert. That is one
    grouped count, with no ordered pass over all buckets.
    """
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    breaching = metrics.where(F.col("errors") > threshold)
    step = F.expr(f"make_dt_interval(0, 0, 0, {seconds})")
    reached = breaching.select("errors", "bucket_end", F.explode(F.sequence(F.lit(0), F.lit(held - 1))).alias("ahead"))
    return (
        reached.select((F.col("bucket_end") + F.col("ahead") * step).alias("alert_at"), "errors")
        .groupBy("alert_at")
        .agg(F.count("*").alias("n"), F.min("errors").alias("min_errors"), F.sum("errors").alias("total_errors"))
        .where(F.col("n") == held)
        .drop("n")
    )


def cost_alerts(daily_metrics: DataFrame, limit: float = 50.0) -> DataFrame:
    """Days whose cost is above the limit; expects one-day buckets."""
    return daily_metrics.where(F.col("cost") > limit).select(
        F.to_date("bucket_start").alias("day"), F.col("cost").alias("daily_cost")
    )


def execution_rate(metrics: DataFrame, seconds: int) -> DataFrame:
    """Executions per second of each bucket."""
    return metrics.select("bucket_start", (F.col("executions") / seconds).alias("per_second"))


def error_rate(metrics: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Buckets whose share of errors is above the threshold."""
    rate = F.col("errors") / F.col("executions")
    return metrics.select("bucket_start", "executions", "errors", rate.alias("error_rate")).where(
        F.col("error_rate") > threshold
    )
