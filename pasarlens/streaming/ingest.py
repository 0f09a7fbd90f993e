"""Arriving batch files: ingest, validate, refresh summaries and append new keys.

Every sink is safe to replay: a micro-batch writes its own ``batch_id`` partition, or replaces whole summary
partitions, so running it twice leaves the same table.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from pasarlens.operators.quality import file_validation
from pasarlens.operators.records import defaulted, judged_records
from pasarlens.plans.snapshot_reports import daily_totals
from pasarlens.sources.key_index import BUCKET_KEYS, KeyIndex
from pasarlens.sources.landing import CORRUPT, envelope_schema, numbered_records


#: Files of one micro-batch: a backlog is worked off in several, none is left out.
FILES_PER_BATCH = 1000


def _file_stream(spark: SparkSession, archive: str | None, files_per_batch: int) -> DataStreamReader:
    reader = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "[!._]*")
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader


def stream_envelopes(
    spark: SparkSession, path: str, archive: str | None = None, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """A stream of landed batch files. With ``archive`` a finished file is moved there after its batch."""
    reader = _file_stream(spark, archive, files_per_batch).schema(envelope_schema()).option("multiLine", True)
    documents = reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return documents.select("*", F.col("_metadata.file_path").alias("file_path"))


def stream_documents(
    spark: SparkSession, path: str, archive: str | None = None, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """A stream of landed files as whole texts, for checks that must see unreadable files too."""
    files = _file_stream(spark, archive, files_per_batch).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("file_path"), "value")


#: Fixed value: the name Spark gives to the folder of a null partition value.
NO_VALUE_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process every file that is there, then stop; the checkpoint remembers what was done."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _replace_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def ingest(envelopes: DataFrame, table: str, rejected: str, checkpoint: str, as_of: date) -> None:
    """Parse, validate, normalise and append; turned-away records and unreadable files go to ``rejected`` with the
    reason, so every record of every file is in one of the two tables."""

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        # typed rows are kept, and the text of the few that are turned away; the documents are read once
        judged = judged_records(numbered_records(batch), "file_path", "has_record", "file_reason", "file_text").persist()
        try:
            _replace_batch(defaulted(judged.where("has_record AND accepted"), as_of), table, batch_id)
            turned_away = judged.where("has_record AND reason IS NOT NULL").select("file_path", F.col("text").alias("record"), "reason")
            files = judged.where("file_reason IS NOT NULL").select(
                "file_path", F.col("file_text").alias("record"), F.col("file_reason").alias("reason")
            )
            _replace_batch(turned_away.unionByName(files), rejected, batch_id)
        finally:
            judged.unpersist()

    run_available(envelopes, checkpoint, one_batch)


def validate(documents: DataFrame, results: str, checkpoint: str) -> None:
    """Per arriving file: structure check and valid and invalid record counts."""

    run_available(
        documents, checkpoint, lambda batch, batch_id: _replace_batch(file_validation(batch), results, batch_id)
    )


def refresh_daily_summary(
    batches: DataFrame, raw: str, summary: str, checkpoint: str, raw_schema: T.StructType
) -> None:
    """Append each batch to ``raw`` and recompute the summary of the months it touches.

    The summary has one row per day and is stored by month, so a partition is a useful file and not one row. The
    months of a batch are observed while it is written; only their folders of ``raw`` are listed and read back. Rows
    without a day have a folder and a summary row of their own.
    """
    spark = batches.sparkSession
    month = F.trunc("ingestion_date", "month")
    stored = T.StructType(
        [*raw_schema, T.StructField("month", T.DateType()), T.StructField("batch_id", T.LongType())]
    )

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        observed = batch.observe(seen, F.collect_set(month).alias("months"), F.count_if(month.isNull()).alias("undated"))
        stamped = observed.select("*", month.alias("month"), F.lit(batch_id).alias("batch_id"))
        stamped.hint("rebalance", F.col("month")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("month", "batch_id").parquet(raw)
        touched = seen.get  # bounded by the calendar
        folders = [f"{raw}/month={m}" for m in touched["months"]]
        if touched["undated"]:
            folders.append(f"{raw}/month={NO_VALUE_FOLDER}")
        if not folders:
            return
        table = spark.read.schema(stored).option("basePath", raw).parquet(*folders)
        by_month = daily_totals(table).withColumn("month", F.trunc("summary_date", "month"))
        by_month.hint("rebalance", F.col("month")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("month").parquet(summary)

    run_available(batches, checkpoint, one_batch)


def append_new_keys(
    batches: DataFrame, table: str, checkpoint: str, key: str, schema: T.StructType, bucket_keys: int = BUCKET_KEYS
) -> None:
    """Append the rows of each micro-batch whose key no earlier batch has stored.

    Rows are stored by batch; their keys beside them, in the index ``table``_keys, of which a batch reads filters and the few buckets
    that may hold one of its keys. The keys are read back from the stored rows, so that the fresh ones are found once. Everything a
    batch writes is replaced when it is replayed.
    """
    spark = batches.sparkSession
    kind = schema[key].dataType
    index = KeyIndex(spark, f"{table}_keys", key, kind, bucket_keys)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        fresh, figures = index.fresh(batch, batch_id)
        _replace_batch(fresh, table, batch_id)
        written = spark.read.schema(T.StructType([T.StructField(key, kind)])).parquet(f"{table}/batch_id={batch_id}")
        index.add(written, batch_id, figures)

    run_available(batches, checkpoint, one_batch)
