"""Landed batches: JSON documents ``{metadata, data: [record, ...]}`` and newline-delimited records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pasarlens.schemas import ENVELOPE
from pasarlens.sources.tables import append_table, write_json

CORRUPT = "_corrupt"


def envelope_schema() -> T.StructType:
    return T.StructType([*ENVELOPE, T.StructField(CORRUPT, T.StringType())])


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: metadata, data, file_path; unreadable files have the ``_corrupt`` column set."""
    reader = spark.read.schema(envelope_schema()).option("multiLine", True).option("recursiveFileLookup", True)
    documents = reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return documents.select("*", F.col("_metadata.file_path").alias("file_path"))


def envelope_records(envelopes: DataFrame) -> DataFrame:
    """One row per record with its batch; files without a ``data`` list give none."""
    return envelopes.select(
        F.col("metadata.ingestion_id").alias("ingestion_id"),
        F.col("metadata.source").alias("source"),
        "file_path",
        F.explode("data").alias("record"),
    )


def numbered_records(envelopes: DataFrame) -> DataFrame:
    """``file_path``, ``record`` and the file's fault, if any, as ``file_reason`` and ``file_text`` beside its first record; a file without
    records gives one row that is no record (``has_record``)."""
    broken = F.col(CORRUPT).isNotNull()
    reason = F.when(broken, "unreadable file").when(F.col("data").isNull(), "no data")
    rows = envelopes.select("file_path", F.col(CORRUPT).alias("_text"), reason.alias("_reason"), F.posexplode_outer("data").alias("_at", "record"))
    first = F.coalesce("_at", F.lit(0)) == 0
    return rows.select(
        "file_path", "record", F.col("_at").isNotNull().alias("has_record"), F.when(first, F.col("_reason")).alias("file_reason"), F.when(first, F.col("_text")).alias("file_text")
    )


def unreadable_files(envelopes: DataFrame) -> DataFrame:
    """Files that give no records, as ``file_path``, ``record`` (the text, where it is no JSON) and ``reason``."""
    broken = F.col(CORRUPT).isNotNull()
    reason = F.when(broken, "unreadable file").when(F.col("data").isNull(), "no data")
    return envelopes.select("file_path", F.col(CORRUPT).alias("record"), reason.alias("reason")).where(
        F.col("reason").isNotNull()
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as text, for structure checks that must see unreadable files too."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("file_path"), "value")


def _batch_id(at: datetime) -> str:
    return f"ING_{at:%Y%m%d_%H%M%S}"


def write_envelopes(df: DataFrame, path: str, at: datetime, source: str, max_records: int = 5000) -> None:
    """Store rows as batch documents of at most ``max_records`` records, one document per file, all in one folder.

    A document is built from rows of one partition only, cut by position, so neither a hot key nor many equal
    rows can make it grow. Sorting the partition first makes the cut the same on a retried task. The writer starts a
    new file after each document. Documents are compressed: as text they are many times the size of the rows.
    """
    numbered = df.sortWithinPartitions(*df.columns).select(
        F.expr(f"monotonically_increasing_id() div {max_records}").alias("_cut"),
        F.struct(*df.columns).alias("_record"),
    )
    batch = F.concat(F.lit(_batch_id(at) + "_"), F.col("_cut").cast("string"))
    documents = numbered.groupBy("_cut").agg(F.collect_list("_record").alias("data")).select(
        F.to_json(
            F.struct(
                F.struct(
                    batch.alias("ingestion_id"),
                    F.lit(at.isoformat()).alias("ingestion_timestamp"),
                    F.size("data").alias("record_count"),
                    F.lit(source).alias("source"),
                ).alias("metadata"),
                "data",
            )
        ).alias("value"),
    )
    documents.select("value").write.mode("append").option("maxRecordsPerFile", 1).option("compression", "gzip").text(f"{path}/{_batch_id(at)}")


def write_landing(df: DataFrame, path: str, at: datetime, source: str) -> dict[str, object]:
    """Append one batch as compressed newline-delimited JSON in files of bounded size and return its metadata.

    The count is observed in the stage that writes, where a repeated task is counted once.
    """
    seen = Observation()
    batch = _batch_id(at)
    stamped = df.observe(seen, F.count("*").alias("record_count")).withColumns(
        {
            "ingestion_id": F.lit(batch),
            "ingestion_timestamp": F.lit(at.isoformat()),
            "source": F.lit(source),
        }
    )
    write_json(stamped, path, "append", "ingestion_id")
    return {
        "ingestion_id": batch,
        "ingestion_timestamp": at.isoformat(),
        "record_count": seen.get["record_count"],
        "source": source,
    }


def landing_batches(spark: SparkSession, path: str, record_schema: T.StructType) -> DataFrame:
    """Record count per landed batch, read back from the landing folder."""
    stamped = T.StructType(
        [*record_schema, T.StructField("ingestion_timestamp", T.StringType()), T.StructField("source", T.StringType())]
    )
    landed = spark.read.schema(stamped).json(path)
    return landed.groupBy("ingestion_id", "source").agg(F.count("*").alias("record_count"))


def new_files(spark: SparkSession, path: str, as_of: date) -> DataFrame:
    """Files below ``path`` last changed on or after the day; only file metadata is looked at."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("modifiedAfter", f"{as_of.isoformat()}T00:00:00")
        .load(path)
    )
    return listed.select(F.col("path").alias("file_path"), F.col("modificationTime").alias("modified"), "length")


class TooManyBadRecords(RuntimeError):
    """A load met more unreadable lines than it may skip."""


def load_ndjson(
    spark: SparkSession,
    source: str,
    target: str,
    staging: str,
    schema: T.StructType,
    max_bad_records: int = 10,
    partition: str | None = None,
    cluster: Sequence[str] = (),
) -> dict[str, int]:
    """Append newline-delimited JSON to a Parquet table, skipping at most ``max_bad_records`` bad lines.

    The declared schema may hold more columns than the table already has: the table grows, and
    ``read_growing_table`` fills older rows with nulls. Lines are parsed once, into ``staging``; the counts come
    from that pass, and nothing reaches the table if there are too many bad lines.
    """
    seen = Observation()
    bad: Column = F.col(CORRUPT).isNotNull()
    parsed = (
        spark.read.schema(T.StructType([*schema, T.StructField(CORRUPT, T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(source)
        .observe(seen, F.count("*").alias("lines"), F.count_if(bad).alias("bad"))
    )
    parsed.where(~bad).drop(CORRUPT).write.mode("overwrite").parquet(staging)
    counts = seen.get
    if counts["bad"] > max_bad_records:
        raise TooManyBadRecords(f"{counts['bad']} bad records, {max_bad_records} allowed")
    append_table(spark.read.schema(schema).parquet(staging), target, partition, cluster)
    return {"loaded": counts["lines"] - counts["bad"], "bad": counts["bad"]}


def read_growing_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def schema_growing_append(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Union by name; columns only one side has become null on the other."""
    return table.unionByName(batch, allowMissingColumns=True)
